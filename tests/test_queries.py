"""Every registered query beside its SQL at the smallest scale.

``python tests/check.py /root/testdata/sf0.01`` does the same at any other one.
"""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cargolens.plans import oracle
from cargolens.plans import queries as registered
from cargolens.sources import adapters
from tests.check import compare, duck

SMALL = "/root/testdata/sf0.001"
SQL = oracle.statements()


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


def test_every_query_has_sql():
    assert set(SQL) == set(registered.registry()) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(spark, connection, name):
    assert compare(spark, connection, SMALL, registered.registry()[name], SQL[name]) is None


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()


def plan(spark, name, folder=SMALL):
    return registered.registry()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["status_overview", "route_delay", "daily_delivery_kpi", "event_volume", "top_delayed_routes"])
def test_line_only_queries_skip_the_orders_table(spark, name):
    assert "orders.parquet" not in plan(spark, name)


def test_scans_read_only_the_columns_they_use(spark):
    text = plan(spark, "top_delayed_routes")
    schema = next(line for line in text.splitlines() if "lineitem.parquet" in line).split("ReadSchema: ")[1]
    assert schema.count(":") == 3  # partkey and suppkey for the route, quantity for the delay


@pytest.mark.parametrize("name", ["bronze_events", "delivery_current_state", "vehicle_current_state", "fleet_current_state"])
def test_latest_rows_are_cut_before_the_shuffle(spark, name):
    lines = plan(spark, name).splitlines()
    partial = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert exchange < partial  # the plan prints the last step first


def test_cost_charts_drop_the_branches_they_do_not_need(spark):
    text = plan(spark, "bi_actual_cost")
    assert text.count("lineitem.parquet") == 1 and "Join [business_date" not in text and "count(distinct" not in text


def test_a_dashboard_reads_its_view_once(spark):
    single, whole = plan(spark, "bi_route_risk"), plan(spark, "bi_cost_dashboard")
    assert whole.count("lineitem.parquet") == single.count("lineitem.parquet") and whole.count("Expand") == 1
    text = plan(spark, "trends_all")
    assert text.count("lineitem.parquet") == plan(spark, "trend_day").count("lineitem.parquet") and text.count("Expand") == 1
    lines = text.splitlines()
    assert next(i for i, x in enumerate(lines) if "Exchange" in x) < next(i for i, x in enumerate(lines) if "partial_" in x)


def test_no_query_plans_python_or_a_cross_join(spark):
    streams = {name for name in SQL if name.endswith("_stream")} | {"cost_gold_table", "history_layout", "cost_gold_incremental"}
    for name in sorted(set(SQL) - streams):
        text = plan(spark, name)
        for word in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in text, (name, word)


def test_batch_date_filter_reaches_the_partition_scan(spark, tmp_path):
    from datetime import date

    from cargolens.operators.lifecycle import for_date
    from cargolens.sources.adapters import view

    view(spark, SMALL, "transportation_costs").limit(200).write.partitionBy("business_date").parquet(str(tmp_path / "t"))
    text = for_date(spark.read.parquet(str(tmp_path / "t")), date(1998, 9, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(business_date" in text


def test_the_cost_upsert_shuffles_the_table_once_and_the_return_trips_once(spark, sf_dir):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, str(1 << 16))  # the small tables only
    try:
        df = registered.registry()["upsert_cost"](spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    final = plan[: plan.index("Initial Plan")]
    shuffles = [line for line in final.splitlines() if "+- Exchange hashpartitioning(" in line]
    assert len(shuffles) == 2 and final.count("ReusedExchange [cost_id") == 1, final


@pytest.mark.parametrize("name", ["json_parse_events", "contract_split_json"])
def test_json_is_made_and_parsed_by_as_many_tasks_as_there_are_events_for(spark, sf_dir, monkeypatch, name):
    monkeypatch.setattr(adapters, "EVENTS_PER_TASK", 4000)
    rows = []
    monkeypatch.setattr(registered.parse, "delivery_json", lambda events, source, made=registered.parse.delivery_json: rows.append(events) or made(events, source))
    registered.registry()[name](spark, sf_dir)
    tasks = [r["n"] for r in rows[0].groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(tasks) == 15 and sum(tasks) == 60_000 and max(tasks) < 5000
