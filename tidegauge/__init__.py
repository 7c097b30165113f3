"""Telemetry analytics for database servers, written as plain Spark jobs."""

__version__ = "0.1.0"
