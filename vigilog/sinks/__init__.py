"""Writers: parsed tables, samples, reports, models, Kafka, alerts."""
