"""Date/time expressions (DT1-DT4).  The session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """DT1: parse with coerce (unparsable -> NULL, never an error under ANSI)."""
    c = _c(c)
    if dtype is not None and isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c.cast(T.TimestampType())
    if dtype is not None and isinstance(dtype, T.DateType):
        return c.cast(T.TimestampType())
    return F.try_to_timestamp(c.cast("string"))


def calendar_columns(ts: str | Column) -> list[Column]:
    """DT2: hour, day_of_week (Monday = 0), is_weekend, month."""
    ts = _c(ts)
    dow = F.weekday(ts)
    return [F.hour(ts).cast("int").alias("hour"), dow.cast("int").alias("day_of_week"),
            F.when(dow >= 5, 1).otherwise(0).cast("int").alias("is_weekend"),
            F.month(ts).cast("int").alias("month")]


def epoch_days(ts: str | Column) -> Column:
    """Timestamp as fractional days since the epoch."""
    return F.unix_micros(_c(ts).cast(T.TimestampType())) / F.lit(86400e6)


def recency(ts: str | Column, min_ts: str | Column, max_ts: str | Column) -> Column:
    """DT3: 1 - age/max_age clipped to [0, 1]; max_age = 0 -> divide by 1."""
    age = epoch_days(max_ts) - epoch_days(ts)
    span = epoch_days(max_ts) - epoch_days(min_ts)
    span = F.when(span > 0, span).otherwise(F.lit(1.0))
    r = F.lit(1.0) - age / span
    return F.when(r.isNull(), F.lit(None)).otherwise(F.greatest(F.least(r, F.lit(1.0)), F.lit(0.0)))


def days_apart(a: str | Column, b: str | Column) -> Column:
    """DT4: whole days between two dates/timestamps."""
    return F.datediff(F.to_date(_c(a)), F.to_date(_c(b)))
