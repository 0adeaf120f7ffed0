"""Daily device-telemetry analytics expressed as Spark DataFrame transformations."""
