"""Telemetry lakehouse on PySpark: tolerant decode, bronze history, latest-state silver tables."""
