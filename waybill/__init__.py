"""Spark operators for event delivery: intake, outbox, publishing, consumption and their telemetry."""
