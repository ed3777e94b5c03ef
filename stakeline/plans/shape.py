"""Result shape shared by all named queries: plain types only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, ShortType


def plain(frame: DataFrame) -> DataFrame:
    """Decimals as doubles, dates as ISO text, small integers as bigint."""
    columns = []
    for f in frame.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (IntegerType, ShortType)):
            c = c.cast("bigint")
        columns.append(c.alias(f.name))
    return frame.select(*columns)
