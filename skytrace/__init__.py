"""Batch telemetry analytics for multi-beacon flights, written as Spark DataFrame jobs."""
