import os
import subprocess
import sys
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from vigilog.llm import chunks
from vigilog.llm.queries import remainder

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    start, counts = docs, {}
    kinds = docs.dtypes
    kept = {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        counts[name] = docs.count()
        kept[name] = docs
        if name != "packing":
            assert docs.dtypes == kinds
    toxic = {r.doc_id for r in start.select("doc_id").subtract(kept["toxicity"].select("doc_id")).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(labels.get(i, 1) == 1 for i in toxic)
    one = kept["near_duplicates"]
    assert {tuple(r) for r in one.collect()} <= {tuple(r) for r in kept["toxicity"].collect()}
    assert one.select("text").distinct().count() == one.count()
    cleaned = {r.doc_id: r for r in kept["repeated_passages"].collect()}
    want = {r.doc_id: r.text for r in chunks.without_repeats(one).collect()}
    assert {k: r.text for k, r in cleaned.items()} == want and all(r.n_chars == len(r.text) for r in cleaned.values())
    mixed = Counter(r.doc_id for r in kept["mixing"].collect())
    assert max(mixed.values()) <= 3 and set(mixed) <= set(cleaned)
    packed = kept["packing"].where("start = 0").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r.doc_id: r.n for r in packed} == mixed
    assert [n for n, _ in pipeline.STAGES] == list(counts)


def test_learning_leaves_held_out_rows(spark):
    ids = spark.range(300).select(F.col("id").alias("doc_id")).withColumn("r", remainder(3)).collect()
    import zlib

    assert all(r.r == zlib.crc32(str(r.doc_id).encode()) % 3 for r in ids)


def test_library_works_without_the_subpackage(tmp_path):
    """As after deleting the subpackage, its tests and the pipeline."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = (
        "import sys\n"
        "class Absent:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('vigilog.llm', 'corpus_pipeline'):\n"
        "            raise ModuleNotFoundError(name=name)\n"
        "sys.meta_path.insert(0, Absent())\n"
        "import __spark_entry__ as e\n"
        "assert not any(n.startswith('op') or n == 'pipeline' for n in e.queries())\n"
        "assert len(e.queries()) > 70\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
