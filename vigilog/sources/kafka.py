"""Message envelopes from Kafka, and building and opening envelopes."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.functions.parse import is_replay_noise, parse_lines
from vigilog.schema import ENVELOPE_SCHEMA

# Default topic and consumer group.
TOPIC = "server-logs"
GROUP = "anomaly-detector-group"


def source_options(
    servers: str, topic: str = TOPIC, group: str = GROUP, max_offsets: int | None = None
) -> dict[str, str]:
    """Reader options: whole topic from the start, bounded micro-batches.

    Progress is kept in the query's checkpoint, so the group only names the reader.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "groupIdPrefix": group,
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_messages(spark: SparkSession, servers: str, **kw) -> DataFrame:
    """Stream of ``value`` and the broker's topic, partition and offset; needs the Kafka connector.

    The broker's columns have names of their own, since envelopes hold a ``topic`` too;
    pass them as ``keep`` to ``open_envelopes``. Together they are a message's key.
    """
    reader = spark.readStream.format("kafka").options(**source_options(servers, **kw))
    return reader.load().select(
        F.col("value").cast("string").alias("value"), *[F.col(c).alias(f"broker_{c}") for c in ("topic", "partition", "offset")]
    )


def stripped(line: Column) -> Column:
    return F.regexp_replace(line, r"(?U)^\s+|\s+$", "")


def build_envelopes(
    lines: DataFrame, producer: int, topic: str | None = TOPIC, sent_at: Column | None = None
) -> DataFrame:
    """``line_no, value`` -> envelope columns; noise lines are not sent.

    ``producer`` identifies the sending job, ``sent_at`` defaults to now.
    """
    now = F.unix_micros(F.current_timestamp()) / 1e6
    fields = [
        F.col("line_no"),
        stripped(F.col("value")).alias("raw_log"),
        (now if sent_at is None else sent_at).cast("double").alias("sent_at"),
        F.lit(producer).cast("bigint").alias("producer"),
    ]
    if topic is not None:
        fields.append(F.lit(topic).alias("topic"))
    return lines.where(~is_replay_noise(F.col("value"))).select(*fields)


def to_messages(envelopes: DataFrame) -> DataFrame:
    """Envelopes as JSON in the single column ``value``."""
    return envelopes.select(F.to_json(F.struct(*envelopes.columns)).alias("value"))


def open_envelopes(messages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """JSON messages -> envelope columns, next to the columns in ``keep``."""
    return messages.select(
        *(keep or []), F.from_json("value", ENVELOPE_SCHEMA).alias("_e")
    ).select(*(keep or []), "_e.*")


def enriched_entries(envelopes: DataFrame) -> DataFrame:
    """Parsed entries of envelopes with their message fields attached.

    ``kafka_offset`` is the envelope's line number. Empty and unparsable texts
    give no row.
    """
    fields = {
        "kafka_offset": F.col("line_no"),
        "producer_pid": F.col("producer"),
        "message_sent_at": F.col("sent_at"),
    }
    used = ("line_no", "producer", "sent_at", "topic", "raw_log")
    keep = [c for c in envelopes.columns if c not in used]
    return parse_lines(
        envelopes.where(F.col("raw_log") != "").select(
            *keep, "raw_log", *[c.alias(n) for n, c in fields.items()]
        ),
        "raw_log",
    )
