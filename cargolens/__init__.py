"""Logistics analytics on Spark: delivery events, fleet telemetry and transport cost."""
