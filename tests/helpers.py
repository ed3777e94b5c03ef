from datetime import date, datetime

from pyspark.sql import functions as F

from stakeline.functions import scalars as X
from stakeline.sources import schemas

STREAMS = "oil_mbd double, dry_gas_mmscfd double, assoc_gas_mmscfd double, condensate_mbd double"


def day(text):
    return None if text is None else date.fromisoformat(text)


def production(spark, rows):
    """rows: dicts; anything left out is null or a default."""
    base = dict(field="ALPHA", unit="ALPHA", operator="OP", region="R", location="L", unit_type="T", period="202606",
                oil_mbd=None, assoc_gas_mmscfd=None, dry_gas_mmscfd=None, condensate_mbd=None, water_mbd=None,
                gas_pipeline=None, lon=1.0, lat=55.0)
    full = [{**base, "object_id": i, **r} for i, r in enumerate(rows)]
    for r in full:
        r.setdefault("reported_at", r["period"] and datetime(int(r["period"][:4]), int(r["period"][4:]), 15))
    names = [c.strip().split(" ")[0] for c in schemas.PRODUCTION.split(",")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], schemas.PRODUCTION)


def classification(spark, rows=()):
    return spark.createDataFrame([(f, u, c, "") for f, u, c in rows], schemas.CLASSIFICATION)


def stakes(spark, rows):
    """rows: (field, company, pct, start, end[, operator_flag, label])"""
    full = []
    for r in rows:
        f, c, p, s, e, *rest = r
        flag = rest[0] if rest else "N"
        label = rest[1] if len(rest) > 1 else ("Current" if e is None else f"Previous-{s[:4]} to {e[:4]}")
        full.append((f, "OFFSHORE", "PRODUCING", c, float(p), flag, day(s), day(e), label))
    return spark.createDataFrame(full, schemas.STAKES)


def history(spark, rows):
    """rows: (field, period[, oil]) as a field history."""
    full = [(r[0], r[1], float(r[2]) if len(r) > 2 else 10.0, 0.0, 0.0, 0.0) for r in rows]
    frame = spark.createDataFrame(full, f"field string, period string, {STREAMS}")
    names = [c.strip().split(" ")[0] for c in STREAMS.split(",")]
    return frame.withColumn("month_start", X.month_start(F.col("period"))).select(
        "field", "period", "month_start", *[F.col(n).cast("decimal(18,3)").alias(n) for n in names])


def rows(frame, *columns):
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def one(frame):
    found = frame.collect()
    assert len(found) == 1, found
    return found[0].asDict()
