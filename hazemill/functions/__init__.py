"""Column expressions: AQI and calendar attributes."""
