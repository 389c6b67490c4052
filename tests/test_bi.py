from datetime import date

import pytest
from pyspark.sql import functions as F

from cargolens.operators import bi


@pytest.mark.parametrize(
    ("metric", "kind"),
    [("avg_delay_minutes", "avg"), ("delay_rate", "avg"), ("actual_cost", "sum"), ("cost_per_delivery", "sum"), ("cost_delay_risk_score", "sum")],
)
def test_default_aggregate(metric, kind):
    assert bi.default_aggregate(metric) == kind


def test_dashboards_name_known_charts_and_every_chart_is_used():
    used = [name for charts, _ in bi.DASHBOARDS.values() for name in charts]
    assert sorted(used) == sorted(bi.CHARTS) and len(used) == 12
    assert bi.DASHBOARDS["cost_and_routes"][1] == ("business_date", "warehouse_id", "region", "route_id")


def test_pivot_has_a_column_per_value_and_metric(spark):
    df = spark.createDataFrame(
        [("n", "fast", 0.2, 4.0), ("n", "fast", 0.4, 6.0), ("s", "slow", 1.0, 9.0)],
        "region string, service_level string, delay_rate double, avg_delay_minutes double",
    )
    out = bi.chart(df, bi.CHARTS["delay_pivot"], pivot_values=["slow", "fast"])
    assert out.columns == ["region", "fast_delay_rate", "fast_avg_delay_minutes", "slow_delay_rate", "slow_avg_delay_minutes"]
    north, south = out.orderBy("region").collect()
    assert north[1:] == (pytest.approx(0.3), 5.0, None, None)
    assert south[1:] == (None, None, 1.0, 9.0)
    assert bi.chart(df, bi.CHARTS["delay_pivot"], pivot_values=["slow", "fast"], limit=1).count() == 1
    found = bi.chart(df, bi.CHARTS["delay_pivot"]).columns
    assert found == out.columns  # discovered values come sorted too


def test_limit_keeps_the_greatest_and_breaks_ties_by_key(spark):
    df = spark.range(5000).select(
        F.lpad(F.col("id").cast("string"), 5, "0").alias("status"), F.when(F.col("id") < 10, 5).otherwise(1).alias("event_count")
    )
    assert bi.chart(df, bi.CHARTS["status_overview"]).count() == 5000
    rows = bi.chart(df, bi.CHARTS["status_overview"], limit=bi.ROW_LIMIT).collect()
    assert len(rows) == bi.ROW_LIMIT
    assert [r["status"] for r in rows[:11]] == [f"{i:05d}" for i in range(11)]


def test_big_number_and_its_average_option(spark):
    df = spark.createDataFrame([(10.0,), (20.0,)], "cost_per_delivery double")
    spec = bi.CHARTS["cost_per_delivery"]
    assert bi.chart(df, spec).first()[0] == 30.0
    assert bi.chart(df, spec, aggregates={"cost_per_delivery": "avg"}).first()[0] == 15.0


def test_filters(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, d), r, "r1") for d in (1, 2, 3) for r in ("n", "s")], "business_date date, region string, route_id string"
    )
    assert bi.apply_filters(df).count() == 6
    some = bi.apply_filters(df, start=date(2024, 1, 2), end=date(2024, 1, 3), selections={"region": ["n"], "route_id": []})
    assert [tuple(r) for r in some.collect()] == [(date(2024, 1, 2), "n", "r1")]


ROWS = "business_date date, warehouse_id string, region string, route_id string, actual_cost bigint, cost_variance double, cost_per_delivery double"


def test_a_dashboard_equals_its_charts(spark):
    charts = {name: bi.CHARTS[name] for name in ("actual_cost", "cost_variance", "route_cost", "warehouse_cost")}
    day = date(2024, 1, 1)
    df = spark.createDataFrame(
        [(day, "w1", "n", "r1", 1, 0.5, 2.0), (day, "w1", "n", None, 2, 0.25, 4.0), (day, None, None, None, 4, None, None), (day, "w2", "s", "r1", None, 1.0, 1.0)], ROWS
    )
    out = bi.dashboard(df, charts)
    for name, spec in charts.items():
        columns = [*spec.groupby, *spec.metrics]
        got = out.where(F.col("chart") == name)
        assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, bi.chart(df, spec).select(*columns).collect()))
        rest = [c for c in out.columns if c not in ("chart", *columns)]
        assert got.where(" OR ".join(f"{c} IS NOT NULL" for c in rest)).isEmpty()
    assert bi.dashboard(df.limit(0), charts).isEmpty()
    with pytest.raises(ValueError, match="delay_pivot"):
        bi.dashboard(df, {"delay_pivot": bi.CHARTS["delay_pivot"]})
