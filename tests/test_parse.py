import json
from datetime import datetime

from pyspark.sql import functions as F

from cargolens.operators import contract, parse
from cargolens.sources.schemas import DELIVERY_EVENT_V1, VEHICLE_TELEMETRY_V1

EVENT = {
    "schema_version": 1, "event_id": "e1", "event_type": "IN_TRANSIT", "event_timestamp": "2024-05-01T10:00:00Z",
    "delivery_id": "d1", "vehicle_id": "v1", "source": "test",
    "payload": {"status": "DELIVERED", "latitude": 40.5, "longitude": 49.5, "capacity_used": 10, "capacity_total": 20},
}


def values(spark, *documents):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in documents], "value string")


def one(spark, document):
    return parse.parse_delivery_events(values(spark, document)).withColumn("valid", parse.is_valid_delivery()).first()


def test_flat_fields_and_defaults(spark):
    row = one(spark, {**EVENT, "unknown": {"x": 1}})
    assert (row["event_id"], row["status"], row["event_timestamp"]) == ("e1", "DELIVERED", datetime(2024, 5, 1, 10))
    assert (row["latitude"], row["capacity_used"]) == (40.5, 10.0)
    assert [row[c] for c in ("shipment_id", "region", "service_level", "payment_method")] == [""] * 4
    assert [row[c] for c in ("delay_minutes", "package_count", "order_value")] == [0, 0, 0.0]
    assert row["planned_arrival_timestamp"] is None
    assert row["valid"] and not row["is_corrupt"]


def test_raw_json_is_untouched(spark):
    text = json.dumps({**EVENT, "note": "it's \"quoted\" \\ here"})
    assert one(spark, text)["raw_event"] == text


def test_numbers_as_text_are_read_and_nonsense_is_the_default(spark):
    payload = {"delay_minutes": "12", "package_count": "3.0", "order_value": "9.5", "latitude": "north", "longitude": "NaN"}
    row = one(spark, {**EVENT, "payload": payload})
    assert [row[c] for c in ("delay_minutes", "package_count", "order_value")] == [12, 3, 9.5]
    assert (row["latitude"], row["longitude"]) == (0.0, 0.0)


def test_status_falls_back_to_the_event_type(spark):
    assert one(spark, {**EVENT, "payload": {}})["status"] == "IN_TRANSIT"
    without = {k: v for k, v in EVENT.items() if k != "payload"}
    row = one(spark, without)
    assert row["status"] == "IN_TRANSIT" and row["valid"]


def test_inadmissible_events(spark):
    for change in ({"schema_version": 2}, {"event_id": "  "}, {"event_id": None}, {"event_timestamp": "soon"}):
        assert not one(spark, {**EVENT, **change})["valid"], change


def test_malformed_json_is_marked(spark):
    row = one(spark, '{"event_id": "e1", ')
    assert row["is_corrupt"] and row["valid"] is False
    assert row["raw_event"] == '{"event_id": "e1", '


def test_blank_arrival_is_null(spark):
    row = one(spark, {**EVENT, "payload": {"planned_arrival_timestamp": "", "estimated_arrival_timestamp": "2024-05-01T11:00:00Z"}})
    assert row["planned_arrival_timestamp"] is None
    assert row["estimated_arrival_timestamp"] == datetime(2024, 5, 1, 11)


def reasons(spark, document, which):
    df = values(spark, document).withColumn("e", F.from_json("value", which.wire_schema()))
    return contract.with_reasons(df, which, root="e", raw="value").first()["reasons"]


def test_delivery_contract_over_json(spark):
    assert reasons(spark, EVENT, DELIVERY_EVENT_V1) == []
    assert reasons(spark, {**EVENT, "more": 1}, DELIVERY_EVENT_V1) == []  # unknown fields are tolerated
    bad = {**EVENT, "event_type": "LOST", "payload": {**EVENT["payload"], "capacity_total": 0, "package_count": 0, "latitude": "x"}}
    assert reasons(spark, bad, DELIVERY_EVENT_V1) == [
        "event_type:enum",
        "payload.latitude:type",
        "payload.capacity_total:exclusive_minimum",
        "payload.package_count:minimum",
    ]
    assert reasons(spark, {k: v for k, v in EVENT.items() if k != "payload"}, DELIVERY_EVENT_V1)[-1] == "payload:required"


def test_telemetry_forbids_unknown_fields(spark):
    document = dict.fromkeys([f.name for f in VEHICLE_TELEMETRY_V1.fields]) | {"surprise": 1}
    assert "extra_fields" in reasons(spark, document, VEHICLE_TELEMETRY_V1)


def test_telemetry_bad_field_is_null_and_bad_row_is_marked(spark):
    rows = parse.parse_telemetry(
        values(spark, {"event_id": "e1", "speed_kmh": "fast", "event_timestamp": "2024-01-01T00:00:00.123456Z"}, "not json")
    ).collect()
    assert (rows[0]["speed_kmh"], rows[0]["vehicle_id"], rows[0]["is_corrupt"]) == (None, None, False)
    assert rows[0]["event_timestamp"] == datetime(2024, 1, 1, 0, 0, 0, 123456)
    assert rows[1]["is_corrupt"]
