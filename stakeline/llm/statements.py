"""Check statements (DuckDB SQL) of the named queries that SQL can express."""

from __future__ import annotations

# two windows of words per item; a document word in any occurrence of a window is hit
_DECONTAMINATION = r"""
with words as (
  select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as pos, len(w) as n
  from (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents)),
item_words as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (
  select distinct item_id, array_to_string(w[i:i + 12], ' ') as win, least(13, len(w)) as size
  from (select item_id, w, unnest(range(1, greatest(2, len(w) - 11))) as i from item_words where len(w) > 0)),
sizes as (select distinct size from windows),
document_windows as (
  select doc_id, pos, size, string_agg(word, ' ') over (partition by doc_id, size order by pos rows between current row and 12 following) as win,
         n from words, sizes where size = 13
  union all
  select w.doc_id, w.pos, s.size, (select string_agg(v.word, ' ' order by v.pos) from words v
                                  where v.doc_id = w.doc_id and v.pos between w.pos and w.pos + s.size - 1), w.n
  from words w, sizes s where s.size < 13),
hits as (select d.doc_id, d.pos, d.size, w.item_id from document_windows d join windows w on d.win = w.win and d.size = w.size
         where d.pos + d.size - 1 <= d.n),
hit_words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(pos, pos + size)) as p from hits) group by doc_id),
hit_items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
              from (select distinct doc_id, item_id::varchar as item from hits) group by doc_id)
select d.doc_id, d.n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(i.n_items, 0) as n_items,
       sha256(coalesce(i.items, '')) as items_sha256,
       coalesce(h.n_hit, 0) > 0 and 20 * coalesce(h.n_hit, 0) >= d.n_words as contaminated
from (select doc_id, coalesce(len(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')), 0) as n_words from documents) d
left join hit_words h using (doc_id) left join hit_items i using (doc_id)
"""

_QUALITY = r"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as pos, len(w) as n
          from (select doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w from texts)),
windows as (select doc_id, pos, n, string_agg(word, ' ') over (partition by doc_id order by pos rows between current row and 4 following) as win from words),
repeated as (select doc_id, pos from (select *, count(*) over (partition by doc_id, win) as c from windows where pos + 4 <= n) where c > 1),
covered as (select doc_id, count(distinct p) as n_repeat_words from (select doc_id, unnest(range(pos, pos + 5)) as p from repeated) group by doc_id),
lines as (select doc_id, unnest(string_split(t, chr(10))) as line from texts),
real_lines as (select doc_id, line, len(line) as size,
    len(string_split_regex(trim(line, ' '), '[ \t\n\x0B\f\r]+')) < 8 as short from lines where regexp_matches(line, '[^\x20\x09-\x0D]')),
judged as (select *, (regexp_matches(line, '[.!?…:;,"»”’'')\]。！？][ \t\n\x0B\f\r]*$') or not short)
    and not (short and regexp_matches(line, '(^|[ \t\n\x0B\f\r])[|»›•·>]([ \t\n\x0B\f\r]|$)'))
    and not regexp_matches(line, '(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie policy|accept (all )?cookies|enable javascript|sign up for|log ?in to|click here|lorem ipsum)') as passes
    from real_lines),
line_counts as (select doc_id, count(*) - count(distinct line) as n_dup_lines,
    1 - coalesce(sum(size) filter (passes), 0)::double / sum(size) as lost from judged group by doc_id),
base as (select t.doc_id, coalesce((select max(n) from words w where w.doc_id = t.doc_id), 0) as n_words,
    len(regexp_replace(t.t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    len(t.t) - len(translate(t.t, '#*$%&|<>', '')) as n_symbols,
    coalesce(l.n_dup_lines, 0) as n_dup_lines, coalesce(c.n_repeat_words, 0) as n_repeat_words, coalesce(l.lost, 1) as lost
    from texts t left join line_counts l using (doc_id) left join covered c using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and lost <= 0.5 as kept
from base
"""

_LINE_DEDUP = r"""
with lines as (
  select doc_id, unnest(ls) as line, unnest(range(len(ls))) as pos
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents)),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
crowded as (
  select key, max(doc_id) as holder from keyed where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
judged as (select l.*, c.key is not null and l.doc_id <> c.holder as goes from keyed l left join crowded c on l.key = c.key)
select doc_id, count(*) as n_lines, count(*) filter (goes) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not goes), '')) as kept_sha256
from judged group by doc_id
"""

_LEXICAL = r"""
with doc_terms as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
item_terms as (
  select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
sizes as (select doc_id, count(*)::bigint as n from doc_terms group by doc_id),
total as (select count(*)::bigint as docs, sum(n)::bigint as terms from sizes),
counts as (select doc_id, term, count(*)::bigint as tf from doc_terms where term in (select term from item_terms) group by doc_id, term),
weights as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint as w from counts, total group by term, docs),
wanted as (select item_id, term, count(*)::bigint as times from item_terms group by item_id, term),
scores as (
  select i.item_id, c.doc_id, sum(i.times * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (25 + (75 * s.n * t.docs) // t.terms))))::bigint as score
  from wanted i join weights w using (term) join counts c using (term) join sizes s using (doc_id), total t group by i.item_id, c.doc_id)
select item_id, rank::int as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0) where rank <= 10
"""

_NEGATIVES = r"""
with rows as (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.id as anchor, b.id as other, a.label = b.label as same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::bigint as score
  from rows a, rows b where a.id % 50 = 0 and a.id <> b.id),
positives as (
  select anchor, other, score from (select *, row_number() over (partition by anchor order by score desc, other) as k from pairs where same)
  where k <= 5),
negatives as (
  select p.anchor, p.other as positive, n.other as negative, p.score as positive_score, n.score as negative_score,
         row_number() over (partition by p.anchor, p.other order by n.score desc, n.other) as rank
  from positives p join pairs n on n.anchor = p.anchor and not n.same
  where 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score)
select anchor as anchor_id, positive as positive_id, rank::int as rank, negative as negative_id, positive_score, negative_score
from negatives where rank <= 3
"""

STATEMENTS = {"op13_hard_negatives": _NEGATIVES, "op12_lexical_search": _LEXICAL, "op11_line_dedup": _LINE_DEDUP, "op2_decontamination": _DECONTAMINATION, "op9_quality": _QUALITY}
