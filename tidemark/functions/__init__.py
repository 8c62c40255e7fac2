"""Column expressions: clocks, validity, alarms."""
