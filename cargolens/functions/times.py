"""Event-time helpers. The session time zone is UTC (see ``session.tune``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SINK_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def parse_time(text: Column) -> Column:
    """ISO-8601 text to a timestamp; blank or malformed text becomes null."""
    return F.try_to_timestamp(text)


def as_event_time(df: DataFrame, name: str = "event_timestamp") -> DataFrame:
    """Accept an event time that a source delivered as text."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return df.withColumn(name, parse_time(F.col(name)))
    return df


def epoch_millis(ts: Column) -> Column:
    """Version of an event: its event time in epoch milliseconds."""
    return F.unix_millis(ts.cast("timestamp"))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMM")


def sink_text(ts: Column, *, epoch_when_null: bool = False) -> Column:
    """Timestamp as serving-table text; optionally the epoch for a missing one."""
    value = F.coalesce(ts, F.timestamp_seconds(F.lit(0))) if epoch_when_null else ts
    return F.date_format(value, SINK_FORMAT)
