from decimal import Decimal

import pytest

from cargolens.operators import contract, quality
from cargolens.plans.queries import COST_QUALITY, TELEMETRY_QUALITY
from cargolens.sources.schemas import VEHICLE_TELEMETRY_V1
from tests.test_costs import cost, frame

EQUALITY = {"equality": {"total": {"formula": "a + b"}}}


def counts(df, rules):
    return {r["rule"]: r["failed_count"] for r in quality.failed_counts(df, quality.rules(rules)).collect()}


@pytest.mark.parametrize(
    ("total", "a", "b", "failed"),
    [
        ("100.00", "60.00", "40.00", 0),
        ("100.02", "60.00", "40.00", 1),
        ("100.01", "60.00", "40.00", 1),  # compared as doubles, the gap is a little over 0.01
        ("60.00", "60.00", None, 0),  # a null part counts as zero
        (None, "60.00", "40.00", 0),  # a null total passes
    ],
)
def test_equality(spark, total, a, b, failed):
    row = tuple(None if v is None else Decimal(v) for v in (total, a, b))
    df = spark.createDataFrame([row], "total decimal(12,2), a decimal(12,2), b decimal(12,2)")
    assert counts(df, EQUALITY) == {"equality:total": failed}


def test_null_is_no_negative_and_negative_is(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (-1, None)], "a int, b int")
    assert counts(df, {"non_negative": ["a", "b"]}) == {"non_negative": 1}


def test_one_row_with_two_nulls_fails_once(spark):
    df = spark.createDataFrame([(None, None), (1, 1)], "a int, b int")
    assert counts(df, {"not_null": ["a", "b"]}) == {"not_null": 1}


def test_accepted_values_skip_nulls(spark):
    df = spark.createDataFrame([("RUNNING",), ("BROKEN",), (None,)], "engine_status string")
    rules = {"accepted_values": TELEMETRY_QUALITY["accepted_values"]}
    assert counts(df, rules) == {"accepted_values:engine_status": 1}


def test_no_rules_no_outcome(spark):
    assert quality.enforce(spark.range(1), "ds", {}).collect() == []


def test_empty_formula_raises_when_it_has_no_columns(spark):
    with pytest.raises(ValueError, match="at least one column"):
        quality.rules({"equality": {"total": {"formula": " + "}}})


def test_missing_columns_are_listed_in_order():
    with pytest.raises(ValueError, match="missing columns: a, b, total, z"):
        quality.check_columns("ds", ["y"], {**EQUALITY, "not_null": ["z", "y"]})


def test_all_failures_in_one_message(spark):
    df = frame(spark, cost("a", fuel_cost=Decimal(-1)), cost(None))
    with pytest.raises(ValueError) as error:
        quality.enforce(df, "delivery.costs", COST_QUALITY)
    assert "delivery.costs" in str(error.value)
    for part in ("'not_null': 1", "'non_negative': 1", "'equality:actual_total_cost': 1"):
        assert part in str(error.value)


def test_clean_rows_pass(spark):
    found = quality.enforce(frame(spark, cost("a"), cost("b")), "ds", COST_QUALITY).collect()
    assert [tuple(r) for r in found] == [("not_null", 0), ("non_negative", 0), ("equality:actual_total_cost", 0)]


def test_all_rules_share_one_scan(spark, sf_dir):
    from cargolens.sources.adapters import view

    counts = quality.failed_counts(view(spark, sf_dir, "transportation_costs"), quality.rules(COST_QUALITY))
    assert counts._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet") == 1


GOOD = (1, "e1", "VEHICLE_TELEMETRY", "2024-01-01T00:00:00Z", "2024-01-01T00:00:01Z", "VEH-101", "DRV-001",
        40.0, 49.0, 62.0, 68.0, 88.0, 1000.0, "RUNNING", "IN_TRANSIT")
TELEMETRY_SCHEMA = (
    "schema_version int, event_id string, event_type string, event_timestamp string, ingestion_timestamp string, "
    "vehicle_id string, driver_id string, latitude double, longitude double, speed_kmh double, fuel_level_pct double, "
    "engine_temperature_c double, odometer_km double, engine_status string, vehicle_status string"
)


def changed(**fields):
    names = [f.name for f in VEHICLE_TELEMETRY_V1.fields]
    return tuple(fields.get(n, v) for n, v in zip(names, GOOD))


@pytest.mark.parametrize(
    ("fields", "reason"),
    [
        ({}, None),
        ({"schema_version": 2}, "schema_version:const"),
        ({"event_id": ""}, "event_id:min_length"),
        ({"event_id": None}, "event_id:required"),
        ({"event_type": "HEARTBEAT"}, "event_type:const"),
        ({"event_timestamp": "yesterday"}, "event_timestamp:date_time"),
        ({"vehicle_id": "VEH-1"}, "vehicle_id:pattern"),
        ({"driver_id": "xDRV-001"}, "driver_id:pattern"),
        ({"latitude": 90.5}, "latitude:maximum"),
        ({"longitude": -181.0}, "longitude:minimum"),
        ({"speed_kmh": 180.0}, None),
        ({"speed_kmh": 180.1}, "speed_kmh:maximum"),
        ({"engine_temperature_c": None}, "engine_temperature_c:required"),
        ({"engine_status": "BROKEN"}, "engine_status:enum"),
        ({"vehicle_status": "LOST"}, "vehicle_status:enum"),
    ],
)
def test_telemetry_contract(spark, fields, reason):
    df = spark.createDataFrame([changed(**fields)], TELEMETRY_SCHEMA)
    valid, quarantined = contract.split(df, VEHICLE_TELEMETRY_V1)
    assert valid.count() == (reason is None)
    assert [r["reasons"] for r in quarantined.collect()] == ([] if reason is None else [[reason]])


def test_several_reasons_and_extra_column(spark):
    df = spark.createDataFrame([(*changed(speed_kmh=-1.0, schema_version=3), "x")], TELEMETRY_SCHEMA + ", extra string")
    reasons = contract.with_reasons(df, VEHICLE_TELEMETRY_V1).first()["reasons"]
    assert reasons == ["schema_version:const", "speed_kmh:minimum", "extra_fields"]
