"""The two batch jobs, end to end: read, guard, validate, build layers, write, publish, check."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from cargolens.operators import costs, quality
from cargolens.operators import events as ev
from cargolens.operators.integrity import orphans
from cargolens.operators.latest import latest_by_key
from cargolens.operators.lifecycle import for_date, high_water_mark, incremental, require_rows
from cargolens.session import tune
from cargolens.sources.metadata import Dataset
from cargolens.sources.schemas import COST_KPI_COLUMNS, DAILY_KPI_COLUMNS
from cargolens.sources.tables import (
    SORT_KEYS,
    arrange,
    ensure_namespace,
    publish,
    upsert_table,
    write_mode,
    write_table,
)

Save = Callable[[DataFrameWriter], None]


@dataclass(frozen=True)
class Run:
    """One execution of a batch job. The moment is an input, so a rerun can repeat it.

    ``last_date`` turns a dated run into a backfill of a closed range: one job, which
    replaces the partitions of all its dates.
    """

    run_id: str
    batch_date: date | None = None
    last_date: date | None = None
    moment: datetime | None = None
    provider: str = "parquet"

    def rows_of(self, df: DataFrame) -> DataFrame:
        return for_date(df, self.batch_date, last_date=self.last_date)

    @property
    def stamp(self) -> datetime:
        return self.moment or datetime.now(UTC)


def _store(df: DataFrame, name: str, sort: tuple[str, ...], mode: str, run: Run) -> None:
    ensure_namespace(df.sparkSession, name)
    write_table(
        arrange(df, "business_date", sort), name, partition="business_date", mode=mode, provider=run.provider
    )


def daily_kpi_job(events: DataFrame, run: Run, bronze_table: str, gold_table: str, save: Save) -> int:
    """Delivery KPI: every event counts in the KPI, only the bronze table is deduplicated.

    The history is held, so the guard, bronze and the KPI see the same rows and its database is read
    once. The gold table is read back for publishing, so the KPI is computed once.
    """
    spark = tune(events.sparkSession)
    held = events.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        require_rows(held, "the delivery event history")
        enriched = ev.enrich(held)
        _store(ev.bronze_events(enriched), bronze_table, SORT_KEYS["delivery_events"], "create_or_replace", run)
        kpi = ev.stamp(ev.daily_kpi(enriched), F.lit(run.stamp))
        _store(kpi, gold_table, SORT_KEYS["daily_delivery_kpi"], "create_or_replace", run)
    finally:
        held.unpersist()
    return publish(spark.table(gold_table), DAILY_KPI_COLUMNS, save)


def cost_job(source: DataFrame, dataset: Dataset, run: Run, save: Save, *, source_system: str) -> int:
    """Transportation cost: validated source to bronze, silver, gold and the serving table.

    A database source is held for guard, validation and the first layer, so that all
    three see the same rows and the database is read once; files are cheaper to scan
    again, column by column. Every later layer reads the one written before it. A
    dated run publishes its dates only.
    """
    spark = tune(source.sparkSession)
    held = run.rows_of(source)
    if dataset.source_type == "postgres":
        held = held.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        require_rows(held, dataset.dataset_id, run.batch_date)
        quality.enforce(held, dataset.dataset_id, dataset.quality)
        names = dataset.target("iceberg")
        mode = write_mode(run.batch_date)
        layer = costs.bronze(
            held,
            run_id=run.run_id,
            source_system=source_system,
            ingested_at=F.lit(run.stamp),
            batch_date=None if run.last_date else run.batch_date,
        )
        _store(layer, names["bronze_table"], ("cost_id",), mode, run)
    finally:
        held.unpersist()
    bronze_rows = run.rows_of(spark.table(names["bronze_table"]))
    _store(costs.silver(bronze_rows), names["silver_table"], ("cost_id",), mode, run)
    silver_rows = run.rows_of(spark.table(names["silver_table"]))
    kpi = ev.stamp(costs.gold(silver_rows), F.lit(run.stamp))
    _store(kpi, names["gold_table"], SORT_KEYS["daily_transportation_cost_kpi"], mode, run)
    return publish(run.rows_of(spark.table(names["gold_table"])), COST_KPI_COLUMNS, save)


def load_job(source: DataFrame, dataset: Dataset, table: str, *, partition: str, update: Sequence[str], run: Run) -> int:
    """Move a source into one lake table as its metadata says; returns the rows taken.

    ``snapshot`` replaces the table. ``merge`` and ``append`` take the rows changed at or after
    the newest change the table already holds, and those without a change time, so the mark cannot
    drift from the data, equal times are not lost and a failed run simply starts from the same mark again.
    A merge repeats what it took before without effect; an append leaves out the keys the table has.
    """
    spark = tune(source.sparkSession)
    kind = str(dataset.ingestion.get("load_type", "snapshot"))
    if kind not in ("snapshot", "merge", "append"):
        raise ValueError(f"{dataset.dataset_id}: unknown load type {kind!r}")
    ensure_namespace(spark, table)
    if kind == "snapshot" or not spark.catalog.tableExists(table):
        rows = source if kind == "append" or kind == "snapshot" else latest_by_key(source, dataset.primary_key, _order(dataset))
        write_table(arrange(rows, partition), table, partition=partition, provider=run.provider)
        return spark.table(table).count()
    mark = high_water_mark(spark.table(table), _watermark(dataset))
    changed = incremental(source, _watermark(dataset), mark)
    if kind == "append":
        stored = incremental(spark.table(table), _watermark(dataset), mark)
        changed = changed.join(stored.select(*dataset.primary_key), dataset.primary_key, "left_anti").select(*source.columns)
    changed = changed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        taken = changed.count()
        if taken and kind == "merge":
            upsert_table(
                spark, table, changed, keys=dataset.primary_key, update=update, version=_order(dataset), partition=partition
            )
        elif taken:
            write_table(changed, table, partition=partition, mode="append", provider=run.provider)
        return taken
    finally:
        changed.unpersist()


def _watermark(dataset: Dataset) -> str:
    if not dataset.watermark_column:
        raise ValueError(f"{dataset.dataset_id}: ingestion.watermark_column is not set")
    return dataset.watermark_column


def _order(dataset: Dataset) -> list[str]:
    return [_watermark(dataset)]


def relationship_counts(child: DataFrame, dataset: Dataset, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Orphans of every relationship the metadata declares, parents looked up by table name."""
    missing = sorted({t for t, _ in dataset.relationships.values()} - set(tables))
    if missing:
        raise ValueError(f"{dataset.dataset_id}: no table given for {', '.join(missing)}")
    return orphans(child, {column: (tables[t], key) for column, (t, key) in dataset.relationships.items()})
