"""Event-telemetry quality, serving and analytics as Spark DataFrame jobs."""
