"""From raw documents to packed training sequences, in five stages.

Every stage works on all rows its predecessor kept and decides for good: rejected and
duplicate documents go, repeated passages leave the texts, rows are repeated or left out by
the mixture, and the last stage returns token pieces with their places.
"""

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog import storage
from vigilog.llm import chunks, minhash, mixing, packing, toxicity
from vigilog.llm.frame import word_count
from vigilog.llm.queries import remainder, table, word_tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def tidy(stage: Stage) -> Stage:
    """A stage that first removes the intermediate folders of the stage before, whose result has been written by then."""

    @wraps(stage)
    def tidied(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        storage.release(spark, docs)
        with storage.until_release():
            return stage(spark, docs, sf_dir)

    return tidied


@tidy
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator predicts toxic go; it learns from the same rows of ``labels`` as op1."""
    labels = table(spark, sf_dir, "labels").where(remainder(3) != 1)
    model = toxicity.learn(toxicity.labelled(docs, labels), "_text", "_label")
    return toxicity.with_scores(docs, model).where("predicted = 0").select(docs.columns)


@tidy
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates stays, the one with the smallest id."""
    return minhash.deduplicated(docs)


@tidy
def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds leave the text; the document stays."""
    cleaned = chunks.without_repeats(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


@tidy
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    return mixing.repeated(mixing.mix(docs, word_count(F.col("text"))), docs.columns)


@tidy
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids, sequence and offset."""
    return packing.packed_documents(docs.select("doc_id", "source", "text"), word_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Learned scores, sketches, hashed draws and token ids have no SQL form; the stages are
# tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next; a stage's output goes once the next one's is written."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = storage.scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            storage.remove(spark, last)
        docs, last = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
