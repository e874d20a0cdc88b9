import random

from vigilog.sources.follow import _Reader, follow_log, run_numbered
from vigilog.sources.text import read_log
from vigilog.storage import scratch_path


def lines_of(path, part_bytes):
    reader = _Reader({"path": str(path), "partbytes": str(part_bytes)})
    found = []
    for part in reader.partitions({}, reader.latestOffset()):
        found += [v for batch in reader.read(part) for v in batch.column("value").to_pylist()]
    return found


def test_parts_of_any_size_hold_each_line_once(tmp_path, monkeypatch):
    monkeypatch.setattr("vigilog.sources.follow.BLOCK", 7)
    rng = random.Random(4)
    for trial in range(30):
        folder = tmp_path / str(trial)
        folder.mkdir()
        lines = ["x" * rng.choice([0, 1, 2, 9, 40]) + str(i) * rng.randint(0, 1) for i in range(rng.randint(1, 30))]
        (folder / "a.log").write_text("\n".join(lines) + "\nunfinished")
        for size in (1, 2, 5, 16, 1000):
            assert lines_of(folder, size) == lines


def test_appended_restarted_and_replaced_files_have_the_numbers_of_a_batch(spark, tmp_path):
    a, b, hidden = (tmp_path / "logs" / n for n in ("a.log", "b.log", "c.tmp"))
    a.parent.mkdir()
    out, progress = scratch_path(spark, "out"), scratch_path(spark, "progress")

    def run():
        def store(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

        run_numbered(follow_log(spark, str(a.parent), part_bytes=64), store, progress).awaitTermination()

    def stored():
        rows = spark.read.parquet(out).collect()
        return sorted((r.batch, r.file[-5:], r.line_no, r.value) for r in rows)

    text = [f"line {i} ä" * (i % 4) for i in range(60)]
    hidden.write_text("not a log\n")
    a.write_bytes(b"\xef\xbb\xbf" + "\n".join(text[:25]).encode())  # line 25 is unfinished
    run()
    with a.open("a", newline="") as f:
        f.write("\r\n" + "\r\n".join(text[25:]) + "\r\n")
    b.write_text("one\n\nthree\n")
    run()
    run()  # nothing new
    batch = sorted((r.file[-5:], r.line_no, r.value) for r in read_log(spark, [str(a), str(b)]).collect())
    assert sorted(r[1:] for r in stored()) == batch and len(batch) == 63
    b.write_text("other\nlog\n")  # replaced
    with a.open("a") as f:
        f.write("last\n")
    run()
    newest = max(r[0] for r in stored())
    assert [r[1:] for r in stored() if r[0] == newest] == [("a.log", 61, "last"), ("b.log", 1, "other"), ("b.log", 2, "log")]
