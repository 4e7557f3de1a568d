"""Column expressions: arithmetic, time, telemetry text and unit conversion."""
