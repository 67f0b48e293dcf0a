"""Solar-plant telemetry analytics as PySpark DataFrame functions."""
