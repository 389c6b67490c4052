"""Window metrics that late readings correct.

A stream that closes windows with its watermark drops what comes later. Here nothing is dropped: each micro-batch
writes its sums per (window, vehicle) as a slice of its own, below the window's day and in the order of windows. Rows whose window was
closed before the batch go to a side table, with the watermark they missed. Then the windows that close now, and closed ones that
late rows touched, are computed from the slices of their days and published under a version that grows with the
batch; readers take the highest version of a window. So a window costs the sums of its own day, never the history.

All of it depends on the batch and on slices of earlier batches only: a replayed batch writes the same again.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens.functions.times import epoch_millis
from cargolens.operators import telemetry as tm
from cargolens.operators.latest import latest_by_key
from cargolens.sources.tables import arrange
from cargolens.streaming import slices

#: How far event time may run behind before a window is closed.
DELAY = timedelta(seconds=10)
WINDOW_MICROS = 5 * 60 * 1_000_000
#: Moments are kept as microseconds since 1970, which no time zone of a driver can shift.
PROGRESS = T.StructType([T.StructField("newest", T.LongType())])


@dataclass(frozen=True)
class WindowTables:
    root: str

    @property
    def partials(self) -> str:
        return f"{self.root}/partials"

    @property
    def late(self) -> str:
        return f"{self.root}/late_rows"

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    @property
    def progress(self) -> str:
        return f"{self.root}/progress"


def newest_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """Highest event time of all earlier batches: each batch writes it with its own added."""
    earlier = [n for n in slices.slice_names(spark, path) if n < slices.delta(batch_id)]
    return spark.read.schema(PROGRESS).parquet(f"{path}/{earlier[-1]}").head()[0] if earlier else None


def _day(start: Column) -> Column:
    return F.date_format(start, "yyyyMMdd")


def _day_of(moment: int) -> str:
    return datetime.fromtimestamp(moment // 1_000_000, UTC).strftime("%Y%m%d")


def _upto(closed: int | None) -> Column:
    """Whether a window had ended by a moment; none had before the first batch."""
    return F.lit(False) if closed is None else F.col("window_end") <= F.timestamp_micros(F.lit(closed))


def _closed_by(newest: int | None, delay: timedelta) -> int | None:
    return None if newest is None else newest - delay // timedelta(microseconds=1)


def late_rows(admitted: DataFrame, closed: int | None) -> DataFrame:
    """Rows of windows that were closed already, with the watermark and how far they lie behind it."""
    window = F.window("event_timestamp", tm.WINDOW)
    found = admitted.withColumn("window_end", window["end"]).where(_upto(closed))
    mark = F.timestamp_micros(F.lit(closed).cast("long"))
    lag = (epoch_millis(mark) - epoch_millis(F.col("event_timestamp"))) / 1000
    return tm.raw(found).withColumns({"watermark": mark, "lag_seconds": lag})


def write_batch(
    admitted: DataFrame, batch_id: int, tables: WindowTables, limits: tm.AlertLimits = tm.AlertLimits(), delay: timedelta = DELAY
) -> None:
    """One micro-batch of admitted telemetry; ``admitted`` is read three times and should be a table."""
    spark = admitted.sparkSession
    admitted = admitted.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    before = newest_before(spark, tables.progress, batch_id)
    dated = tm.window_partials(admitted, limits).withColumns({"day": _day(F.col("window_start")), "batch": F.lit(batch_id)})
    (
        arrange(dated, "day", ["window_start"])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "batch")
        .parquet(tables.partials)
    )
    slices.write_slice(late_rows(admitted, _closed_by(before, delay)), tables.late, batch_id)
    time = F.col("event_timestamp")
    facts = admitted.agg(F.max(F.unix_micros(time)).alias("newest"), F.collect_set(_day(time)).alias("days")).head()
    newest = max((m for m in (before, facts["newest"]) if m is not None), default=None)
    publish(spark, batch_id, tables, dated.schema, facts["days"], _closed_by(before, delay), _closed_by(newest, delay))
    # The mark of this batch comes last: without it, a batch that broke off is simply run again.
    slices.write_slice(spark.createDataFrame([(newest,)], PROGRESS), tables.progress, batch_id)


def publish(
    spark: SparkSession, batch_id: int, tables: WindowTables, schema: T.StructType, touched: list[str], before: int | None, after: int | None
) -> None:
    """Metrics of the windows that this batch closes, and of closed ones that it touched."""
    if after is None:
        return
    # Lists of days: as long as the retention, or the span of a batch, whatever the number of rows.
    days = slices.folder_values(spark, tables.partials, "day")
    first = _day_of(before - WINDOW_MICROS) if before is not None else ""
    wanted = [d for d in days if d in set(touched) or first <= d <= _day_of(after)]
    if not wanted:
        return
    known = spark.read.schema(schema).option("basePath", tables.partials).parquet(*[f"{tables.partials}/day={d}" for d in wanted])
    known = known.where((F.col("batch") <= batch_id) & _upto(after))
    fresh = known.where(F.col("batch") == batch_id).select("window_start").distinct()
    corrected = known.where(_upto(before)).join(fresh, "window_start", "left_semi")
    closing = known.where(~_upto(before))
    metrics = tm.metrics_of_partials(closing.unionByName(corrected))
    version = epoch_millis(F.col("window_start")) + F.lit(batch_id)
    slices.write_slice(metrics.withColumn("version", version), tables.metrics, batch_id)


def read_metrics(spark: SparkSession, tables: WindowTables) -> DataFrame:
    """The last published metrics of every closed window."""
    return latest_by_key(spark.read.parquet(tables.metrics).drop("slice"), ["window_start"], ["version"])


def read_late(spark: SparkSession, tables: WindowTables) -> DataFrame:
    return spark.read.parquet(tables.late).drop("slice")
