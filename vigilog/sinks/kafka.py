"""Envelopes to Kafka; needs the Kafka connector."""

from pyspark.sql import DataFrame

from vigilog.sources.kafka import TOPIC, to_messages


def sink_options(servers: str, topic: str = TOPIC) -> dict[str, str]:
    """Writer options: wait for all replicas, retry three times."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
    }


def send(envelopes: DataFrame, servers: str, topic: str = TOPIC) -> None:
    to_messages(envelopes).write.format("kafka").options(**sink_options(servers, topic)).save()


def send_stream(envelopes: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC):
    return (
        to_messages(envelopes)
        .writeStream.format("kafka")
        .options(**sink_options(servers, topic))
        .option("checkpointLocation", checkpoint)
        .start()
    )
