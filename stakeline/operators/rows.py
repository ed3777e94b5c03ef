"""Small frames put together without joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def one_row(*frames: DataFrame, missing_ok: bool = False) -> DataFrame:
    """Frames of one row at most, with different columns, as one row.

    There is none where a frame has none, unless ``missing_ok`` leaves its columns null.

    Each frame is computed once; the rows are unioned and collapsed by a maximum
    per column instead of being cross joined. A frame of several rows is an error.
    """
    numbered = [frame.withColumn("__part", F.lit(k)) for k, frame in enumerate(frames)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)
    names = [c for frame in frames for c in frame.columns]
    counts = [F.count_if(F.col("__part") == k) for k in range(len(frames))]
    most = F.greatest(*counts) if len(counts) > 1 else counts[0]
    least = F.least(*counts) if len(counts) > 1 else counts[0]
    collapsed = stacked.agg(*[F.max(c).alias(c) for c in names], most.alias("__most"), least.alias("__least"))
    single = F.when(F.col("__most") > 1, F.raise_error(F.lit("a part has several rows")).cast("boolean")).otherwise((F.col("__least") == 1) | F.lit(missing_ok))
    return collapsed.where(single).select(*names)
