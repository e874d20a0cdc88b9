"""Spark jobs for server-telemetry logs: parse, summarise, detect, alert."""
