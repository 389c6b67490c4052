"""Retention, freshness, readiness and incremental reads."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions.times import epoch_seconds


def _utc(moment: datetime) -> datetime:
    return moment if moment.tzinfo else moment.replace(tzinfo=UTC)


def _like(df: DataFrame, column: str, moment: datetime) -> Column:
    """The moment in the column's own timestamp type, so that the filter reaches the scan."""
    return F.lit(_utc(moment)).cast(df.schema[column].dataType)


def retain(df: DataFrame, as_of: datetime, days: int = 30, column: str = "event_timestamp") -> DataFrame:
    """Rows whose time plus the retention has not passed yet."""
    return df.filter(F.col(column) > _like(df, column, as_of - timedelta(days=days)))


def freshness(df: DataFrame, column: str, as_of: datetime, max_lag_seconds: int) -> DataFrame:
    """One row: volume, newest time, lag behind ``as_of`` and whether the SLA holds."""
    facts = df.agg(F.count(F.lit(1)).alias("row_count"), F.max(column).alias("newest"))
    lag = F.lit(int(_utc(as_of).timestamp())) - epoch_seconds(F.col("newest"))
    return facts.withColumn("lag_seconds", lag).withColumn(
        "is_fresh", F.coalesce((F.col("lag_seconds") <= max_lag_seconds).cast("int"), F.lit(0))
    )


def for_date(
    df: DataFrame, batch_date: date | None, column: str = "business_date", last_date: date | None = None
) -> DataFrame:
    """Rows of one date, or of a closed range of dates; all rows without a date."""
    if batch_date is None:
        return df
    if last_date is None:
        return df.filter(F.col(column) == F.lit(batch_date))
    return df.filter(F.col(column).between(F.lit(batch_date), F.lit(last_date)))


def require_rows(df: DataFrame, what: str, batch_date: date | None = None) -> None:
    """Raise when nothing is there; stops at the first row found."""
    if df.isEmpty():
        raise RuntimeError(f"no rows in {what}" + (f" for {batch_date.isoformat()}" if batch_date else ""))


def readiness(df: DataFrame, batch_date: date, column: str = "business_date") -> DataFrame:
    """Source row count of a date, for the gate before a batch run."""
    return for_date(df, batch_date, column).agg(F.count(F.lit(1)).alias("row_count"))


def incremental(df: DataFrame, column: str, last: datetime | None) -> DataFrame:
    """Rows changed at the stored high-water mark or after it, and rows without a change time; everything on the first run.

    A row that arrives later with exactly the time of the mark is not lost. Rows at the mark come again, which a
    merge by key absorbs and an append must remove by key.
    """
    if last is None:
        return df
    return df.filter((F.col(column) >= _like(df, column, last)) | F.col(column).isNull())


def high_water_mark(df: DataFrame, column: str) -> datetime | None:
    return df.agg(F.max(column)).first()[0]
