"""Start an application's stream from its metadata."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cargolens.operators.telemetry import AlertLimits
from cargolens.session import tune
from cargolens.sources.metadata import Application
from cargolens.sources.readers import kafka_values
from cargolens.streaming import delivery, fleet


def start_application(
    spark: SparkSession,
    application: Application,
    root: str,
    *,
    values: DataFrame | None = None,
    options: Mapping[str, str] | None = None,
    once: bool = False,
) -> list[StreamingQuery]:
    """All queries of an application, writing below ``root``.

    The input is the application's Kafka topic unless ``values`` brings another stream
    of JSON text. A fresh ``root`` replays everything from the earliest offset.
    """
    tune(spark)
    if values is None:
        if not application.topic:
            raise ValueError(f"{application.name}: no streaming topic")
        settings = dict(options or {})
        values = kafka_values(spark, settings["servers"], application.topic, group=settings.get("group"))
    if application.name == "delivery":
        return delivery.start(values, delivery.DeliveryTables(root), once=once)
    if application.name == "fleet":
        return fleet.start(values, fleet.FleetTables(root), AlertLimits.of(application.processing), once=once)
    raise ValueError(f"no stream for application {application.name!r}")
