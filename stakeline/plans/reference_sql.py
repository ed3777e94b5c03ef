"""ANSI views over the test tables, used only to check the Spark plans.

They restate the semantics directly - the interval join is a range join here -
and share no code with the engine.
"""

from __future__ import annotations

import re

FIELD = "concat('FIELD ', lpad(cast({0} as varchar), 10, '0'))"
COMPANY = "concat('Customer#', lpad(cast({0} as varchar), 9, '0'))"


def dec(x: str) -> str:
    return f"coalesce(cast({x} as decimal(28,12)), 0)"


def r3(x: str) -> str:
    """Exact decimal rounded to three places, as a double."""
    return f"cast(round(cast({x} as decimal(38,12)), 3) as double)"


def r3d(x: str) -> str:
    """The same, kept as a decimal."""
    return f"cast(round(cast({x} as decimal(38,12)), 3) as decimal(18,3))"


def sixth(x: str) -> str:
    """Exact x / 6 rounded half-up to twelve places, for x >= 0, without leaving integers."""
    return (
        f"(cast((cast(cast({x} as decimal(38,12)) * 1000000000000 as hugeint) * 2 + 6) // 12 as decimal(38,0))"
        " / 1000000000000)"
    )


def sixth3(x: str) -> str:
    """Exact x / 6 rounded half-up to three places, for x >= 0, as decimal(18,3)."""
    return (
        f"cast(cast((cast(cast({x} as decimal(38,12)) * 1000000000000 as hugeint) + 3000000000) // 6000000000 as decimal(18,0))"
        " * cast(0.001 as decimal(4,3)) as decimal(18,3))"
    )


def pct(a: str, b: str) -> str:
    return f"round(100.0 * cast({a} as double) / case when {b} > 0 then cast({b} as double) end, 3)"


def slug(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g'), '-')"


def norm(x: str) -> str:
    return f"regexp_replace(upper(trim({x})), '\\s+', ' ', 'g')"


def rings(key: str) -> str:
    lon, lat = f"(-14.0 + ({key} % 180) / 10.0)", f"(48.0 + ({key} % 140) / 10.0)"
    def box(x):
        return f"[[{x}, {lat}], [{x} + 0.5, {lat}], [{x} + 0.5, {lat} + 0.5], [{x}, {lat} + 0.5], [{x}, {lat}]]"
    # lists of doubles throughout
    one, two = box(f"cast({lon} as double)"), box(f"cast({lon} as double) + 1.0")
    return (f"case when {key} % 29 = 3 then cast([] as double[][][]) when {key} % 5 = 0 "
            f"then cast([{one}, {two}] as double[][][]) else cast([{one}] as double[][][]) end as rings")


FOUR = ["oil_mbd", "dry_gas_mmscfd", "assoc_gas_mmscfd", "condensate_mbd"]
FIVE = ["oil_mbd", "assoc_gas_mmscfd", "dry_gas_mmscfd", "condensate_mbd", "water_mbd"]
DERIVED = ["liquids_mboed", "natural_gas_mboed", "total_mboed"]
EPOCH_DATE = "strftime(date '1970-01-01' + cast({0} // 86400000 as integer), '%Y-%m-%d')"


def streams(template: str, names=FOUR) -> str:
    return ", ".join(template.replace("{s}", s) for s in names)


VIEWS: dict[str, str] = {}

VIEWS["prod"] = f"""
select {FIELD.format('l_suppkey')} field,
 concat('UNIT ', cast(l_partkey % 7 as varchar), case l_partkey % 7 when 6 then ' STORAGE' when 5 then ' INJECTION' else '' end) unit,
 concat('OPERATOR ', cast((l_suppkey + year(l_shipdate)) % 13 as varchar)) operator,
 case when l_linenumber = 7 then 'UNALLOCATED' else concat('AREA ', cast(l_suppkey % 5 as varchar)) end region,
 case when l_suppkey % 9 = 0 then 'ONSHORE' else 'OFFSHORE' end location,
 concat('TYPE ', cast(l_linenumber % 3 as varchar)) unit_type,
 strftime(l_shipdate, '%Y%m') period,
 case when l_returnflag = 'A' then l_quantity end oil_mbd,
 case when l_returnflag = 'A' then l_extendedprice / 1000 end assoc_gas_mmscfd,
 case when l_returnflag = 'R' then l_extendedprice / 1000 end dry_gas_mmscfd,
 case when l_returnflag = 'R' then l_quantity * abs(l_discount) end condensate_mbd,
 case when l_returnflag = 'N' then l_quantity end water_mbd,
 l_extendedprice * (l_discount - cast(0.001 as double)) gas_pipeline,
 cast(-14.0 as double) + cast(l_partkey % 195 as double) / 10 lon,
 cast(48.0 as double) + cast(l_orderkey % 150 as double) / 10 lat,
 l_orderkey * 10 + l_linenumber object_id
from lineitem"""

VIEWS["listed"] = f"""
select {FIELD.format('s_suppkey')} field, u.unit,
 case when u.unit = 'UNIT 6 STORAGE' and s_nationkey <> 13 then 'storage' else 'production' end classification,
 'listed by name' note
from supplier cross join (values ('UNIT 6 STORAGE'), ('UNIT 5 INJECTION')) u(unit)
where u.unit = 'UNIT 6 STORAGE' or s_acctbal >= 0"""

VIEWS["prodc"] = """
select p.*, coalesce(l.classification, 'production') unit_class
from prod p left join listed l on p.field = l.field and p.unit = l.unit"""

VIEWS["sums"] = f"""
select field, period, {', '.join(f"sum({dec(s)}) {s}" for s in FIVE)}
from prodc where unit_class = 'production' group by field, period"""

VIEWS["hist"] = f"""
select field, period, cast(strptime(period || '01', '%Y%m%d') as date) month_start,
 {', '.join(f"{r3d(s)} {s}" for s in FIVE)},
 {r3d('oil_mbd + condensate_mbd')} liquids_mboed,
 {sixth3('dry_gas_mmscfd + assoc_gas_mmscfd')} natural_gas_mboed,
 {sixth3('(oil_mbd + condensate_mbd) * 6 + dry_gas_mmscfd + assoc_gas_mmscfd')} total_mboed,
 cast(oil_mbd + condensate_mbd as decimal(38,12)) liquids_raw,
 cast(dry_gas_mmscfd + assoc_gas_mmscfd as decimal(38,12)) gas_raw,
 cast((oil_mbd + condensate_mbd) * 6 + dry_gas_mmscfd + assoc_gas_mmscfd as decimal(38,12)) six_total_raw
from sums"""

VIEWS["attrs"] = """
select field, region, location, operator from (
 select field, region, location, operator, row_number() over (partition by field
  order by period desc, object_id, region desc, location desc, operator desc) rn
 from prodc where unit_class = 'production') t where rn = 1"""

VIEWS["spans"] = """
select field, unit_class, unit, min(period) first_period, max(period) last_period,
 (min_by(unit_type, concat(lpad(cast(object_id as varchar), 20, '0'), unit_type))) unit_type
from prodc group by field, unit_class, unit"""

VIEWS["opers"] = f"""
select a.operator, h.period, count(*) field_count, {', '.join(f"cast(sum(h.{s}) as decimal(18,3)) {s}" for s in FIVE)},
 {r3d('sum(liquids_raw)')} liquids_mboed, {sixth3('sum(gas_raw)')} natural_gas_mboed, {sixth3('sum(six_total_raw)')} total_mboed
from hist h join attrs a on h.field = a.field group by a.operator, h.period"""

VIEWS["country"] = f"""
select period, {r3d('sum(liquids_raw)')} liquids_mboed, {sixth3('sum(gas_raw)')} natural_gas_mboed,
 {sixth3('sum(six_total_raw)')} total_mboed from hist group by period"""

VIEWS["newest"] = "select max(period) p from prod"

VIEWS["latestc"] = "select * from prodc where period = (select p from newest)"

VIEWS["latest"] = f"""
select t.field, {slug('t.field')} slug, t.period, f.region, f.location, f.operator, t.unit_count, t.storage_unit_count,
 round(t.lon, 3) lon, round(t.lat, 3) lat,
 {', '.join(f"{r3d('t.' + s)} {s}" for s in FIVE)},
 {r3d('t.oil_mbd + t.condensate_mbd')} liquids_mboed,
 {sixth3('t.dry_gas_mmscfd + t.assoc_gas_mmscfd')} natural_gas_mboed,
 {sixth3('(t.oil_mbd + t.condensate_mbd) * 6 + t.dry_gas_mmscfd + t.assoc_gas_mmscfd')} total_mboed
from (select field, max(period) period, count(distinct case when unit_class = 'production' then unit end) unit_count,
  count(distinct case when unit_class = 'storage' then unit end) storage_unit_count,
  cast(sum(case when unit_class = 'production' then cast(lon as decimal(12,9)) end) as double) / count(case when unit_class = 'production' then lon end) lon,
  cast(sum(case when unit_class = 'production' then cast(lat as decimal(12,9)) end) as double) / count(case when unit_class = 'production' then lat end) lat,
  {', '.join(f"sum(case when unit_class = 'production' then {dec(s)} else 0 end) {s}" for s in FIVE)}
 from latestc group by field) t
join (select *, row_number() over (partition by field order by unit, object_id, region, location, operator) rn
 from latestc where unit_class = 'production') f on t.field = f.field and f.rn = 1
where t.unit_count > 0"""

VIEWS["span"] = """
select o.fk, o.d, o.ok, o.ck, t.n, t.nd, t.pd
from (select o_custkey // 15 fk, o_custkey ck, cast(o_orderdate as date) d, o_orderkey ok from orders) o
join (select fk, d, n, lead(d) over (partition by fk order by d) nd, lag(d) over (partition by fk order by d) pd
 from (select o_custkey // 15 fk, cast(o_orderdate as date) d, count(*) n from orders group by 1, 2) g) t
on o.fk = t.fk and o.d = t.d"""

VIEWS["equity"] = f"""
select case when fk % 100 = 49 then concat('RETIRED FIELD ', cast(fk as varchar))
  when fk % 7 = 3 then concat(case when fk % 10 = 6 and ck % 2 = 0 then 'Field   ' else 'field   ' end, lpad(cast(fk as varchar), 10, '0'))
  when fk % 11 = 5 then concat('OLD FIELD ', cast(fk as varchar)) else {FIELD.format('fk')} end field_name,
 case when fk % 9 = 0 then 'ONSHORE' else 'OFFSHORE' end on_offshore,
 case when fk % 6 = 0 then 'CEASED' else 'PRODUCING' end status,
 {COMPANY.format('15 * (fk // 10) + (ck - 15 * fk + i) % 15')} company_name,
 round(cast(pct as double) / n, 4) interest_pct,
 case when (i = 0 and fk % 8 <> 0) or (i = 2 and fk % 8 = 0) then 'Y' else 'N' end operator_flag,
 s start_date, e end_date,
 case when ok % 61 = 0 then 'Unknown' when e is null or ok % 43 = 0 then 'Current'
  else concat('Previous-', cast(year(s) - case when ok % 31 = 0 then 1 else 0 end as varchar), ' to ', cast(year(e) as varchar)) end period_label
from (
 select fk, ck, ok, n, i, case i when 0 then case when ck % 2 = 1 then 62.5 else 60.0 end - case when ok % 291 = 0 then 5.0 else 0.0 end
   when 1 then case when ck % 2 = 1 then 37.5 else 40.0 end else 0.0 end pct, s, e
 from (select *, case when fk % 100 = 37 then make_date(2090, 1, 4) when pd is null and fk % 17 = 4 then make_date(1950, 1, 1) else d end s,
   case when fk % 100 = 37 then null when ok % 123 = 0 and nd is not null then nd + 60
    when ok % 159 = 0 and nd is not null then d + 15 else nd end e from span) x
 cross join (values (0), (1), (2)) k(i) where i < 2 or fk % 4 = 0
 union all
 select fk, ck, ok, n, 0, 60.0, d, d from span where ok % 29 = 0 and fk % 100 <> 37
) y"""

VIEWS["renamed"] = f"""
select {FIELD.format('s_suppkey')} production_name, concat('OLD FIELD ', cast(s_suppkey as varchar)) equity_name
from supplier where s_suppkey % 11 = 5 and s_suppkey % 100 <> 49 and s_suppkey % 7 <> 3"""

VIEWS["lnames"] = "select distinct field from prodc where unit_class = 'production'"
VIEWS["rnames"] = "select distinct field_name from equity"
VIEWS["rnorm"] = f"""
select {norm('field_name')} k, count(*) n, min(field_name) nm from rnames
where field_name not in (select field from lnames) group by 1"""

VIEWS["matched"] = f"""
select field, coalesce(ex, nm, al) equity_field,
 case when ex is not null then 'exact' when nm is not null then 'normalized' when al is not null then 'alias' end as method
from (select l.field, r.field_name ex, case when r.field_name is null then n.nm end nm, a.equity_name al
 from lnames l left join rnames r on r.field_name = l.field
 left join rnorm n on n.k = {norm('l.field')} and n.n = 1
 left join renamed a on a.production_name = l.field) t"""

VIEWS["act"] = """
select h.field, h.period, h.month_start, m.equity_field, m.method, e.company_name, e.interest_pct, e.start_date, e.end_date, e.operator_flag
from hist h join matched m on h.field = m.field
join equity e on e.field_name = m.equity_field and e.start_date <= h.month_start and (e.end_date is null or h.month_start < e.end_date)"""

VIEWS["actsum"] = """
select field, period, count(*) active_rows, count(*) - count(distinct company_name) extra,
 sum(case when interest_pct > 0 then cast(interest_pct as decimal(9,6)) else 0 end) positive_sum
from act group by field, period"""

VIEWS["starts"] = """
select field_name, cast(date_trunc('month', min(start_date)) as date) first_month, min(start_date) first_start
from equity group by field_name"""

VIEWS["midstarts"] = """
select distinct field_name, cast(date_trunc('month', start_date) as date) m from equity where day(start_date) > 1"""

VIEWS["fm"] = """
select h.field, h.period, h.month_start, m.equity_field, m.method, coalesce(a.active_rows, 0) active_rows,
 cast(round(a.positive_sum, 4) as double) positive_sum, coalesce(a.extra, 0) extra,
 case when m.method is null then 'unmatched' when s.first_month is null then 'no_equity_history'
  when a.active_rows is null then case
   when h.month_start < s.first_month then case when s.first_month > date '2026-11-01' then 'future_only' else 'pre_equity_history' end
   when d.m is not null then 'month_start_boundary' else 'genuine_interval_gap' end
  when a.extra > 0 or a.positive_sum > 100.5 then 'quarantined'
  when abs(round(a.positive_sum, 4) - 100) > 0.5 then 'e1_sum_mismatch' else 'resolved' end category,
 h.oil_mbd, h.dry_gas_mmscfd, h.assoc_gas_mmscfd, h.condensate_mbd
from hist h left join matched m on h.field = m.field left join starts s on s.field_name = m.equity_field
left join midstarts d on d.field_name = m.equity_field and d.m = h.month_start
left join actsum a on a.field = h.field and a.period = h.period"""

VIEWS["pub"] = "select * from fm where period >= '199703'"

VIEWS["att_all"] = f"""
select f.field, f.period, a.company_name company, a.interest_pct, a.start_date, a.end_date, a.operator_flag, f.method,
 {streams("cast(round(f.{s} * cast(a.interest_pct as decimal(9,6)) * cast(0.01 as decimal(3,2)), 6) as decimal(28,6)) {s}")}
from fm f join act a on f.field = a.field and f.period = a.period where f.category = 'resolved' and a.interest_pct > 0"""
VIEWS["att"] = "select * from att_all where period >= '199703'"

VIEWS["act_l"] = """
select l.field, l.period, m.equity_field, m.method, e.company_name, e.interest_pct, e.start_date, e.end_date, e.operator_flag
from latest l join matched m on l.field = m.field join equity e on e.field_name = m.equity_field
 and e.start_date <= cast(strptime(l.period || '01', '%Y%m%d') as date)
 and (e.end_date is null or cast(strptime(l.period || '01', '%Y%m%d') as date) < e.end_date)"""
VIEWS["fml"] = f"""
select l.field, l.period, m.equity_field, m.method, coalesce(a.n, 0) active_rows, cast(round(a.s, 4) as double) positive_sum,
 case when m.method is null then 'unmatched'
  when a.n is null then case when s.first_start > cast(strptime(l.period || '01', '%Y%m%d') as date) then 'future_only' else 'unresolved_gap' end
  when a.extra > 0 or a.s > 100.5 then 'quarantined' when abs(round(a.s, 4) - 100) > 0.5 then 'unresolved_gap' else 'resolved' end category,
 {streams('l.{s}')}
from latest l left join matched m on l.field = m.field left join starts s on s.field_name = m.equity_field
left join (select field, count(*) n, count(*) - count(distinct company_name) extra,
 sum(case when interest_pct > 0 then cast(interest_pct as decimal(9,6)) else 0 end) s from act_l group by field) a on a.field = l.field"""
VIEWS["attl"] = f"""
select f.field, f.period, a.company_name company, a.interest_pct, a.operator_flag, f.method,
 {streams("cast(round(f.{s} * cast(a.interest_pct as decimal(9,6)) * cast(0.01 as decimal(3,2)), 6) as decimal(28,6)) {s}")}
from fml f join act_l a on f.field = a.field where f.category = 'resolved' and a.interest_pct > 0"""


def _category_view(source: str) -> str:
    return " union all ".join(
        f"select period, '{s}' stream, category, count(*) entries, sum({s}) volume from {source} group by period, category"
        for s in FOUR)


def _month_view(source: str) -> str:
    return f"""select *, {pct('resolved', 'total')} coverage_pct from (
 select period, stream, sum(volume) total, sum(case when category = 'resolved' then volume else 0 end) resolved
 from {source} group by period, stream) t"""


def _dominant_view(source: str) -> str:
    return f"""select period, stream, category dominant_category from (
 select period, stream, category, row_number() over (partition by period, stream order by volume desc, category) rn
 from {source} where category <> 'resolved') t where rn = 1"""


VIEWS["cat_all"] = _category_view("fm")
VIEWS["cat"] = _category_view("pub")
VIEWS["mon_all"] = _month_view("cat_all")
VIEWS["mon"] = _month_view("cat")
VIEWS["dom_all"] = _dominant_view("cat_all")
VIEWS["dom"] = _dominant_view("cat")
VIEWS["streamstat"] = """
select m.period, m.stream, m.coverage_pct,
 case when m.total <= 0 or m.coverage_pct < 95 then 'unavailable' when m.coverage_pct >= 99.5 then 'complete' else 'warning' end status,
 case when m.coverage_pct < 95 then coalesce(d.dominant_category, 'unknown') end dominant_category
from mon m left join dom d on m.period = d.period and m.stream = d.stream"""


def _component(inc: str, tot: str) -> str:
    p = pct(inc, tot)
    return (f"case when {tot} <= 0 then 'not_applicable' when {p} < 95 then 'unavailable' "
            f"when {p} >= 99.5 then 'complete' else 'warning' end")


VIEWS["dstat"] = f"""
select *, case when liquids_status = 'not_applicable' and gas_status = 'not_applicable' then 'not_applicable'
  when 'unavailable' in (liquids_status, gas_status) then 'unavailable'
  when 'warning' in (liquids_status, gas_status) then 'warning' else 'complete' end total_status,
 {pct('(li * 6 + gi)', '(lt * 6 + gt)')} total_pct
from (select *, {_component('li', 'lt')} liquids_status, {pct('li', 'lt')} liquids_pct,
  {_component('gi', 'gt')} gas_status, {pct('gi', 'gt')} gas_pct
 from (select period, sum(case when stream in ('oil_mbd', 'condensate_mbd') then resolved else 0 end) li,
   sum(case when stream in ('oil_mbd', 'condensate_mbd') then total else 0 end) lt,
   sum(case when stream in ('dry_gas_mmscfd', 'assoc_gas_mmscfd') then resolved else 0 end) gi,
   sum(case when stream in ('dry_gas_mmscfd', 'assoc_gas_mmscfd') then total else 0 end) gt
  from mon group by period) a) b"""


def derived_values(liq: str, gas: str) -> dict[str, str]:
    """Owner values from raw sums under the month's statuses (columns of dstat)."""
    zero = "cast(0 as decimal(18,3))"
    both = (f"case when liquids_status = 'unavailable' or gas_status = 'unavailable' then null else "
            + sixth3(f"case when liquids_status = 'not_applicable' then 0 else ({liq}) * 6 end "
                     f"+ case when gas_status = 'not_applicable' then 0 else {gas} end") + " end")
    return {
        "liquids_mboed": f"case liquids_status when 'unavailable' then null when 'not_applicable' then {zero} else {r3d(liq)} end",
        "natural_gas_mboed": f"case gas_status when 'unavailable' then null when 'not_applicable' then {zero} else {sixth3(gas)} end",
        "total_mboed": both,
    }


VIEWS["ownvol"] = f"select company, period, {streams('sum({s}) {s}')} from att group by company, period"
_DV = derived_values("oil_mbd + condensate_mbd", "dry_gas_mmscfd + assoc_gas_mmscfd")
_SHORT = {"liquids_mboed": "liquids", "natural_gas_mboed": "gas", "total_mboed": "total"}
VIEWS["series"] = " union all ".join(
    [f"""select o.company, o.period, '{s}' stream, case when n.status <> 'unavailable' then {r3d('o.' + s)} end as value, n.status, n.coverage_pct
 from ownvol o join streamstat n on n.period = o.period and n.stream = '{s}'""" for s in FOUR]
    + [f"""select company, o.period, '{s}' stream, {_DV[s]} as value, {_SHORT[s]}_status status, {_SHORT[s]}_pct coverage_pct
 from ownvol o join dstat d on d.period = o.period""" for s in DERIVED])

VIEWS["subarea"] = f"""
select c object_id, cast(c // 6 as integer) licence_number, concat('P', lpad(cast(c // 6 as varchar), 6, '0')) licence_reference,
 concat(cast(c // 30 as varchar), '/', cast(c % 30 as varchar)) block_reference,
 case when c % 3 = 0 then 'ALL' else concat('PART ', cast(c % 3 as varchar)) end subarea_name,
 case when seg = 'BUILDING' then 'RELINQUISHED' else 'EXTANT' end licence_status,
 ((c * 97) % 20000 - 3000) * 86400000 start_ms,
 case when c % 3 = 0 then null else ((c * 97) % 20000 + 1000) * 86400000 end end_ms,
 case when c % 19 = 2 then 'N/A' else concat({COMPANY.format('e')}, ' (', cast(cast(p as integer) as varchar), '%), ',
  {COMPANY.format('e + 1')}, ' (', cast(cast(100 - p as integer) as varchar), '%)') end holder_text,
 case when c % 23 = 5 then '' when e % 9 = 4 and c % 10 = 7 then 'GROUP OTHER' else concat('GROUP ', cast(e % 40 as varchar)) end holder_group,
 cast(p as double) equity_pct, concat('GROUP ', cast((e + c % 2) % 40 as varchar)) operator_group, {rings('c')}
from (select c_custkey c, c_custkey // 10 e, c_mktsegment seg,
 case when (c_custkey // 10) % 5 = 2 or c_custkey % 4 = 3 then 50.0 else 60.0 end p from customer) t"""

VIEWS["overr"] = f"""
select cast(n_nationkey as integer) line_no, case when n_nationkey % 6 = 5 then ' ' else {COMPANY.format('(n_nationkey // 2) * 4')} end entity,
 concat('REVIEWED ', cast(n_nationkey % 5 as varchar)) display_group, 'reviewed manual mapping' basis,
 case when n_nationkey % 7 = 3 then 'excluded' else 'approved' end status from nation"""
VIEWS["overr1"] = """
select entity, line_no, display_group, basis, status from (
 select *, row_number() over (partition by entity order by line_no desc) rn from overr where trim(entity) <> '') t where rn = 1"""

VIEWS["named_holder"] = r"""
select entity, holder_group grp from (select *, case when holder_text = 'N/A' then null when equity_pct = 50 then null
 else regexp_extract(holder_text, '^(.*?) \(', 1) end entity from subarea) t"""
VIEWS["evid"] = "select entity, grp, count(*) n from named_holder where entity is not null and grp <> '' group by entity, grp"
VIEWS["ents"] = "select distinct company entity from att"
VIEWS["mapping"] = """
select e.entity, case when o.entity is not null then o.display_group when v.groups = 1 then v.only_group else e.entity end display_group,
 case when o.entity is not null then o.basis when v.groups = 1 then 'licence equity group' else 'registered company identity' end basis,
 case when o.entity is not null then o.status when v.groups = 1 then 'approved' else 'unresolved' end status,
 case when o.entity is not null then 'override' when v.groups = 1 then 'evidence' when v.groups > 1 then 'conflict' else 'none' end evidence
from ents e left join overr1 o on o.entity = e.entity
left join (select entity, count(*) groups, min(grp) only_group from evid group by entity) v on v.entity = e.entity"""
VIEWS["members"] = "select entity, display_group grp from mapping"
VIEWS["collapsed"] = "select entity, case when status = 'approved' then display_group else 'Unresolved legal entities' end grp from mapping"


def _group_view(membership: str) -> str:
    return f"""select grp, period, stream, cast(v as decimal(18,3)) as value, members,
 case when present = 0 then 'unavailable' when present < members then 'partial' when complete = members then 'complete'
  when warning > 0 then 'warning' else 'complete' end status
from (select m.grp, s.period, s.stream, sum(s.value) v, count(s.value) present, max(z.members) members,
  count(case when s.value is not null and s.status = 'complete' then 1 end) complete,
  count(case when s.value is not null and s.status = 'warning' then 1 end) warning
 from series s join {membership} m on m.entity = s.company
 join (select grp, count(*) members from {membership} group by grp) z on z.grp = m.grp
 group by m.grp, s.period, s.stream) t"""


VIEWS["gser"] = _group_view("members")
VIEWS["gover"] = _group_view("collapsed")


def _wide_view(source: str, key: str) -> str:
    return f"""select {key}, period, {', '.join(f"max(case when stream = '{s}' then value end) {s}" for s in DERIVED)}
from {source} where stream in ('liquids_mboed', 'natural_gas_mboed', 'total_mboed') group by {key}, period"""


VIEWS["gwide"] = _wide_view("gser", "grp")
VIEWS["gowide"] = _wide_view("gover", "grp")
VIEWS["swide"] = _wide_view("series", "company")


def _grid_view(source: str, key: str) -> str:
    values = derived_values("oil_mbd + condensate_mbd", "dry_gas_mmscfd + assoc_gas_mmscfd")
    return f"""select {key}, field, period, {', '.join(f'{v} {s}' for s, v in values.items())}, liquids_status, gas_status, total_status
from (select g.{key}, g.field, g.period, {streams('coalesce(f.{s}, 0) {s}')}, d.liquids_status, d.gas_status, d.total_status
 from (select a.{key}, a.field, b.period from (select distinct {key}, field from {source}) a
  join (select distinct {key}, period from {source}) b on a.{key} = b.{key}) g
 left join (select {key}, field, period, {streams('sum({s}) {s}')} from {source} group by {key}, field, period) f
  on f.{key} = g.{key} and f.field = g.field and f.period = g.period
 join dstat d on d.period = g.period) t"""


VIEWS["ofs"] = _grid_view("att", "company")
VIEWS["attg"] = "select a.*, c.grp from att a join collapsed c on c.entity = a.company"
VIEWS["gfs"] = _grid_view("attg", "grp")

VIEWS["entry"] = f"""
select object_id, licence_number, licence_reference, block_reference, subarea_name, licence_status,
 {EPOCH_DATE.format('start_ms')} licence_start_date, {EPOCH_DATE.format('end_ms')} licence_end_date, equity_pct,
 holder_group display_group, operator_group, coalesce(holder_group <> '' and holder_group = operator_group, false) operated,
 case when holder_group <> '' then holder_group else 'Unmapped' end grp, rings from subarea"""

VIEWS["episode"] = f"""
select o object_id, case when st = 'O' then 'N' else 'Y' end history, cast(c // 4 as double) licence_number,
 concat('P', lpad(cast(c // 4 as varchar), 6, '0')) licence_reference,
 concat(cast(c // 20 as varchar), '/', cast(c % 20 as varchar)) block_reference, pr licence_status,
 case when o % 499 = 3 then null else dy * 86400000 end start_ms,
 case when st = 'O' then null when o % 211 = 7 then (dy - 1) * 86400000 else (dy + o % 2000) * 86400000 end end_ms,
 case when o % 307 = 11 then '  ' else {COMPANY.format('c')} end licensee_names, concat('GROUP ', cast(c % 25 as varchar)) licensee_group,
 {COMPANY.format('c // 3')} operator_names, case when c % 31 = 0 then '' else concat('GROUP ', cast((c // 3) % 25 as varchar)) end operator_group,
 {COMPANY.format('c // 2')} admin_org, concat('GROUP ', cast((c // 2) % 25 as varchar)) admin_group, {rings('o')}
from (select o_orderkey o, o_custkey c, o_orderstatus st, o_orderpriority pr,
 date_diff('day', date '1970-01-01', cast(o_orderdate as date)) - 11000 dy from orders) t"""
VIEWS["ep"] = f"""
select object_id episode_id, history = 'N' is_current_episode, licence_number, licence_reference, block_reference, licence_status,
 {EPOCH_DATE.format('start_ms')} start_date, {EPOCH_DATE.format('end_ms')} end_date, licensee_names, licensee_group,
 operator_names, operator_group, admin_org, admin_group, rings from episode"""

VIEWS["poly"] = f"""
select cast(s_suppkey as varchar) field_no, case when s_suppkey % 8 = 5 then concat('Field  ', lpad(cast(s_suppkey as varchar), 10, '0'))
 when s_suppkey % 8 = 6 then concat('LOST POLYGON ', cast(s_suppkey as varchar)) else {FIELD.format('s_suppkey')} end polygon_name,
 case when s_nationkey < 12 then 'DETERMINED' else 'PROVISIONAL' end determination_status, {rings('s_suppkey')} from supplier"""
VIEWS["polym"] = f"""
select l.field, coalesce(x.polygon_name, n.nm) polygon_name,
 case when x.polygon_name is not null then 'exact' when n.nm is not null then 'normalized' end as method
from lnames l left join (select distinct polygon_name from poly) x on x.polygon_name = l.field
left join (select {norm('polygon_name')} k, min(polygon_name) nm from (select distinct polygon_name from poly) q
 where polygon_name not in (select field from lnames) group by 1 having count(*) = 1) n on x.polygon_name is null and n.k = {norm('l.field')}"""
VIEWS["polyj"] = f"""
select p.*, m.field matched_field, {slug('m.field')} matched_slug, m.method match_method from poly p
left join (select *, row_number() over (partition by polygon_name order by case when method = 'exact' then 0 else 1 end, field desc) rn from polym where polygon_name is not null) m
 on m.polygon_name = p.polygon_name and m.rn = 1"""
VIEWS["finder"] = f"""
select 'field' as type, field label, {slug('field')} slug from lnames
union all select 'legal-entity', entity, {slug('entity')} from ents
union all select 'operator', operator, operator from (select distinct operator from attrs) t"""


def _uses(sql: str) -> set[str]:
    words = set(re.findall(r"[a-z_0-9]+", sql))
    return {v for v in VIEWS if v in words}


def with_views(sql: str) -> str:
    """``sql`` preceded by the views it needs, in dependency order."""
    needed: set[str] = set()
    pending = list(_uses(sql))
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.add(name)
            pending.extend(_uses(VIEWS[name]))
    order = [v for v in VIEWS if v in needed]
    if not order:
        return sql
    return "with " + ",\n".join(f"{v} as ({VIEWS[v]})" for v in order) + "\n" + sql
