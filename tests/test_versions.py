import os

import pytest

from vigilog.operators.forest import fit_forest
from vigilog.plans import versions
from vigilog.schema import FEATURES
from vigilog.sources.replay import replay_lines
from vigilog.storage import scratch_path


@pytest.fixture(scope="module")
def arriving(table):
    return table.select("host_id", "line_no", *FEATURES).where("line_no <= 300").cache()


def scored(spark, out):
    return {r.line_no: (r.model_version, r.score) for r in spark.read.parquet(out).collect()}


def test_a_stream_without_a_model_is_refused(spark, arriving):
    inbox = scratch_path(spark, "in")
    arriving.limit(3).write.parquet(inbox)
    with pytest.raises(ValueError, match="no model"):
        versions.run_versioned_stream(replay_lines(spark, inbox, schema=arriving.schema), scratch_path(spark, "none"), "host_id", "o", "c")


def test_a_running_query_changes_model_and_a_replayed_batch_does_not(spark, arriving):
    """A new version is taken up without a restart; a batch whose commit was lost keeps the version it had."""
    models, inbox, out, progress = (scratch_path(spark, x) for x in ("models", "in", "out", "progress"))
    first, second = (fit_forest(arriving, ["line_no"], seed=s) for s in (1, 2))
    assert versions.latest_version(spark, models) is None and versions.publish_model(first, models) == 1
    arriving.where("line_no <= 150").coalesce(1).write.parquet(inbox)

    def start(now):
        return versions.run_versioned_stream(replay_lines(spark, inbox, schema=arriving.schema), models, "host_id", out, progress, available_now=now)

    running = start(False)
    running.processAllAvailable()
    assert versions.publish_model(second, models) == 2
    arriving.where("line_no > 150").coalesce(1).write.mode("append").parquet(inbox)
    running.processAllAvailable()
    running.stop()
    before = scored(spark, out)
    ids = [r.line_no for r in arriving.select("line_no").collect()]
    assert {i: v for i, (v, _) in before.items()} == {i: 1 if i <= 150 else 2 for i in ids}

    versions.publish_model(first, models)
    commits = progress + "/commits"
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    os.remove(f"{commits}/{last}")
    for crc in (f"{commits}/.{last}.crc",):
        if os.path.exists(crc):
            os.remove(crc)
    start(True).awaitTermination()
    assert scored(spark, out) == before and spark.read.parquet(out).count() == len(ids)
