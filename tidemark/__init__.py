"""Product-telemetry analytics as plain PySpark DataFrame functions."""
