from datetime import date, datetime
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from cargolens.plans.jobs import Run, cost_job, daily_kpi_job, load_job
from cargolens.plans.queries import COST_QUALITY
from cargolens.sources import tables
from cargolens.sources.metadata import Dataset
from cargolens.sources.schemas import COST_UPDATE_COLUMNS
from tests.test_costs import SCHEMA, cost
from tests.test_events import event

DAY1, DAY2 = date(2024, 5, 1), date(2024, 5, 2)


@pytest.fixture
def lake(spark, request):
    """A database of the test's own."""
    name = "lake_" + request.node.name.lower().replace("[", "_").replace("]", "")[:60]
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    yield f"spark_catalog.{name}"
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def rows(spark, name):
    return sorted(map(tuple, spark.table(name).select("day", "k", "x").collect()))


def days(spark, *triples):
    return spark.createDataFrame(list(triples), "k string, x int, day date")


def test_write_modes(spark, lake):
    name = f"{lake}.t"
    tables.ensure_namespace(spark, name)
    first = days(spark, ("a", 1, DAY1), ("b", 2, DAY2))
    tables.write_table(first, name, partition="day", mode="overwrite_partitions")  # creates it
    tables.write_table(days(spark, ("c", 3, DAY2)), name, partition="day", mode="overwrite_partitions")
    assert rows(spark, name) == [(DAY1, "a", 1), (DAY2, "c", 3)]
    tables.write_table(days(spark, ("c", 3, DAY2)), name, partition="day", mode="overwrite_partitions")
    assert rows(spark, name) == [(DAY1, "a", 1), (DAY2, "c", 3)]
    tables.write_table(days(spark, ("d", 4, DAY1)), name, partition="day", mode="append")
    assert rows(spark, name) == [(DAY1, "a", 1), (DAY1, "d", 4), (DAY2, "c", 3)]
    tables.write_table(first, name, partition="day")
    assert rows(spark, name) == [(DAY1, "a", 1), (DAY2, "b", 2)]
    with pytest.raises(ValueError, match="unknown write mode"):
        tables.write_table(first, name, mode="upsert")


def test_namespace_needs_three_parts():
    assert tables.namespace_of("cat.bronze.t") == "cat.bronze"
    for bad in ("t", "bronze.t", "a..t"):
        with pytest.raises(ValueError, match="catalog.namespace.table"):
            tables.namespace_of(bad)


@pytest.mark.parametrize(
    ("mode", "exists", "call"),
    [
        ("create_or_replace", True, "createOrReplace"),
        ("overwrite_partitions", True, "overwritePartitions"),
        ("overwrite_partitions", False, "createOrReplace"),
        ("append", True, "append"),
    ],
)
def test_iceberg_goes_through_the_v2_writer(spark, mode, exists, call):
    df = MagicMock()
    tables.write_table(df, "c.n.t", partition="day", mode=mode, provider="iceberg", table_exists=exists)
    writer = df.writeTo.return_value.using.return_value
    target = writer.partitionedBy.return_value if call == "createOrReplace" else writer
    getattr(target, call).assert_called_once_with()


def test_publish_writes_named_columns_in_order_and_counts(spark, tmp_path):
    target = str(tmp_path / "out")
    assert tables.publish(days(spark, ("a", 1, DAY1), ("b", 2, DAY2)), ["x", "k"], tables.to_parquet(target)) == 2
    assert spark.read.parquet(target).columns == ["x", "k"]
    published = spark.read.parquet(target).withColumn("business_date", F.lit(DAY1))
    assert tables.require_published(published, DAY1, "kpi") == 2
    with pytest.raises(RuntimeError, match="2024-05-02"):
        tables.require_published(published, DAY2, "kpi")


def test_jdbc_publish_options():
    writer = MagicMock()
    tables.to_jdbc({"url": "jdbc:x"}, "kpi")(writer)
    writer.format.assert_called_once_with("jdbc")
    writer.format.return_value.options.assert_called_once_with(url="jdbc:x", dbtable="kpi")


def test_lake_round_trip(spark, lake):
    assert tables.round_trip(spark, f"{lake}.smoke").first()["message"] == "lake-ok"


def test_upsert_table_rewrites_touched_partitions_only(spark, lake):
    name = f"{lake}.t"
    tables.ensure_namespace(spark, name)
    tables.write_table(days(spark, ("a", 1, DAY1), ("b", 2, DAY2), ("c", 3, date(2024, 5, 3))), name, partition="day")
    # b arrives under another day: it stays where it is; n is new.
    changes = days(spark, ("b", 20, DAY1), ("n", 9, DAY1))
    for _ in range(2):
        touched = tables.upsert_table(spark, name, changes, keys=["k"], update=["x"], version=["x"], partition="day")
        assert touched == 2
        assert rows(spark, name) == [(DAY1, "a", 1), (DAY1, "n", 9), (DAY2, "b", 20), (date(2024, 5, 3), "c", 3)]
    assert [t.name for t in spark.catalog.listTables(lake.split(".")[1])] == ["t"]


def test_a_broken_swap_can_be_finished(spark, lake, monkeypatch):
    name = f"{lake}.t"
    tables.ensure_namespace(spark, name)
    tables.write_table(days(spark, ("a", 1, DAY1)), name, partition="day")
    real, held = tables.finish_swap, []

    def broken(*args):
        held.append(args)
        raise OSError("lost the driver")

    monkeypatch.setattr(tables, "finish_swap", broken)
    with pytest.raises(OSError):
        tables.upsert_table(spark, name, days(spark, ("a", 5, DAY1)), keys=["k"], update=["x"], version=["x"], partition="day")
    assert rows(spark, name) == [(DAY1, "a", 1)]
    real(*held[0])
    assert rows(spark, name) == [(DAY1, "a", 5)]


def test_append_absent(spark, lake):
    name = f"{lake}.t"
    tables.ensure_namespace(spark, name)
    tables.write_table(days(spark, ("a", 1, DAY1)), name, partition="day")
    for _ in range(2):
        tables.append_absent(spark, name, days(spark, ("a", 7, DAY2), ("b", 2, DAY2)), ["k"], ["x"])
    assert rows(spark, name) == [(DAY1, "a", 1), (DAY2, "b", 2)]


def test_compaction_and_retention(spark, lake):
    name = f"{lake}.history"
    tables.ensure_namespace(spark, name)
    frame = spark.createDataFrame([("a", "202401"), ("b", "202403"), ("c", "202405")], "k string, event_month string")
    for _ in range(3):
        tables.write_table(frame, name, partition="event_month", mode="append")
    tables.compact_partition(spark, name, "event_month", "202405", files=1, sort=["k"])
    kept = spark.table(name).filter("event_month = '202405'")
    assert kept.count() == 3 and len(kept.inputFiles()) == 1
    assert tables.drop_expired_months(spark, name, "event_month", datetime(2024, 5, 20), days=30) == ["202401", "202403"]
    assert {r["k"] for r in spark.table(name).collect()} == {"c"}


def dataset(lake):
    return Dataset.parse(
        {
            "dataset_id": "delivery.transportation_costs",
            "application": "delivery",
            "domain": "transportation",
            "source": {"type": "postgres", "table": "transportation_costs"},
            "ingestion": {"primary_key": ["cost_id"], "watermark_column": "updated_at"},
            "targets": {
                "iceberg": {
                    "bronze_table": f"{lake}.costs_bronze",
                    "silver_table": f"{lake}.costs_silver",
                    "gold_table": f"{lake}.costs_gold",
                }
            },
            "quality": COST_QUALITY,
        }
    )


def test_cost_job_full_then_one_date(spark, lake, tmp_path):
    source = spark.createDataFrame([cost("a", day=DAY1), cost("b", day=DAY1), cost("c", day=DAY2)], SCHEMA)
    target = str(tmp_path / "serving")

    def go(df, run):
        return cost_job(df, dataset(lake), run, tables.to_parquet(target, "append"), source_system="test")

    assert go(source, Run("r1", moment=datetime(2024, 5, 3))) == 2
    corrected = spark.createDataFrame([cost("a", actual=210, day=DAY1), cost("c", actual=999, day=DAY2)], SCHEMA)
    for second in (4, 4):  # repeating the dated run changes nothing in the lake
        assert go(corrected, Run("r2", batch_date=DAY1, moment=datetime(2024, 5, second))) == 1
    gold = {r["business_date"]: r for r in spark.table(f"{lake}.costs_gold").collect()}
    assert (gold[DAY1]["actual_cost"], gold[DAY1]["cost_record_count"]) == (210, 1)
    assert (gold[DAY2]["actual_cost"], gold[DAY2]["cost_record_count"]) == (110, 1)  # the other date is untouched
    assert spark.table(f"{lake}.costs_silver").count() == spark.table(f"{lake}.costs_bronze").count() == 2
    assert {r["_pipeline_run_id"] for r in spark.table(f"{lake}.costs_bronze").collect()} == {"r1", "r2"}
    served = spark.read.parquet(target)
    assert served.count() == 4 and served.columns[:4] == ["business_date", "warehouse_id", "region", "route_id"]


def test_cost_job_guards_before_any_write(spark, lake, tmp_path):
    source = spark.createDataFrame([cost("a", day=DAY1), cost(None, day=DAY2)], SCHEMA)
    save = tables.to_parquet(str(tmp_path / "never"))
    with pytest.raises(RuntimeError, match="no rows in delivery.transportation_costs for 2024-06-01"):
        cost_job(source, dataset(lake), Run("r", batch_date=date(2024, 6, 1)), save, source_system="test")
    with pytest.raises(ValueError, match="'not_null': 1"):
        cost_job(source, dataset(lake), Run("r"), save, source_system="test")
    assert not spark.catalog.databaseExists(lake.split(".")[1])


def test_daily_kpi_job(spark, lake, tmp_path):
    from cargolens.sources.schemas import EVENT_COLUMNS

    from tests.test_events import SCHEMA as EVENTS

    df = spark.createDataFrame([event(1, "DELIVERED", 0, 1.0, 2.0), event(1, "DELIVERED", 0, 1.0, 2.0)], EVENTS)
    df = df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in EVENT_COLUMNS])
    run = Run("r", moment=datetime(2024, 5, 2))
    target = str(tmp_path / "kpi")
    assert daily_kpi_job(df, run, f"{lake}.raw_events", f"{lake}.kpi", tables.to_parquet(target)) == 1
    row = spark.read.parquet(target).first()
    assert (row["completed_deliveries"], row["version"]) == (2, 1714608000)
    assert spark.table(f"{lake}.raw_events").count() == 1
    with pytest.raises(RuntimeError, match="no rows"):
        daily_kpi_job(df.limit(0), run, f"{lake}.raw_events", f"{lake}.kpi", tables.to_parquet(target))


def test_cost_update_list_matches_the_schema():
    names = [part.split()[0] for part in SCHEMA.replace("decimal(12,2)", "decimal").split(", ")]
    assert set(COST_UPDATE_COLUMNS) < set(names) and len(COST_UPDATE_COLUMNS) == 15


def test_backfill_replaces_every_date_of_the_range(spark, lake, tmp_path):
    save = tables.to_parquet(str(tmp_path / "serving"), "append")
    days = [date(2024, 5, d) for d in (1, 2, 3)]
    first = spark.createDataFrame([cost(f"c{d}", day=d) for d in days], SCHEMA)
    cost_job(first, dataset(lake), Run("r1", moment=datetime(2024, 5, 4)), save, source_system="t")
    again = spark.createDataFrame([cost(f"c{d}", actual=500, day=d) for d in days], SCHEMA)
    run = Run("r2", batch_date=days[0], last_date=days[1], moment=datetime(2024, 5, 5))
    assert cost_job(again, dataset(lake), run, save, source_system="t") == 2
    gold = spark.table(f"{lake}.costs_gold").orderBy("business_date").collect()
    assert [r["actual_cost"] for r in gold] == [500, 500, 110]
    assert spark.table(f"{lake}.costs_bronze").filter("_batch_date = business_date").count() == 3


def test_merge_load_takes_only_newer_rows(spark, lake):
    name = f"{lake}.costs"
    plan = dataset(lake)
    plan = Dataset(**{**plan.__dict__, "ingestion": {**plan.ingestion, "load_type": "merge"}})

    def go(*rows):
        return load_job(
            spark.createDataFrame(list(rows), SCHEMA), plan, name, partition="business_date", update=COST_UPDATE_COLUMNS, run=Run("r")
        )

    early, late, later = datetime(2024, 5, 1), datetime(2024, 5, 2), datetime(2024, 5, 3)
    assert go(cost("a", updated_at=early), cost("b", updated_at=late, day=DAY2), cost("b", updated_at=early, day=DAY2)) == 2
    assert go(cost("a", actual=300, updated_at=early)) == 0  # not newer than the table
    change = cost("a", actual=300, updated_at=later, route="ignored"), cost("n", updated_at=later, day=DAY2)
    assert go(*change) == 2
    assert go(*change) == 2  # rows at the mark come again, and a merge repeats them without effect
    assert go(cost("x", updated_at=later), cost("y", updated_at=None)) == 2  # late at the mark's time, and without a time
    assert {r["cost_id"] for r in spark.table(name).collect()} == {"a", "b", "n", "x", "y"}
    spark.table(name).filter("cost_id IN ('a', 'b', 'n')").createOrReplaceTempView("seen_before")
    name = "seen_before"
    found = {r["cost_id"]: (r["actual_total_cost"], r["route_id"], r["business_date"]) for r in spark.table(name).collect()}
    assert found == {"a": (300, "r1", DAY1), "b": (110, "r1", DAY2), "n": (110, "r1", DAY2)}


def test_load_types(spark, lake):
    name, plan = f"{lake}.costs", dataset(lake)
    source = spark.createDataFrame([cost("a")], SCHEMA)
    for kind, expected in (("snapshot", 1), ("snapshot", 1), ("append", 1)):
        data = Dataset(**{**plan.__dict__, "ingestion": {**plan.ingestion, "load_type": kind}})
        load_job(source, data, name, partition="business_date", update=[], run=Run("r"))
        assert spark.table(name).count() == expected
    with pytest.raises(ValueError, match="unknown load type"):
        odd = Dataset(**{**plan.__dict__, "ingestion": {"load_type": "guess"}})
        load_job(source, odd, name, partition="business_date", update=[], run=Run("r"))
