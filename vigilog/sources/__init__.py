"""Readers: raw log text, parsed tables, reports, models, Kafka, replayed logs."""
