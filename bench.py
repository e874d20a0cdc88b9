"""Headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each job is run once to warm up and then timed; BENCH_COPIES > 1 repeats the
log with other host numbers, for a larger input than the tables give.
"""

import itertools
import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.inputs import log_lines  # noqa: E402
from vigilog.functions.parse import parse_lines, with_parse  # noqa: E402
from vigilog.operators import evaluate, forest, paging, rolling, stats  # noqa: E402
from vigilog.plans import scoring  # noqa: E402
from vigilog.storage import materialize, shared_root  # noqa: E402
from vigilog.streaming import baseline  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    copies = int(os.environ.get("BENCH_COPIES", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    raw = log_lines(spark, sf_dir)
    n = raw.count()
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    raw = raw.withColumn("_copy", copy).select(
        (F.col("line_no") + F.col("_copy") * n).alias("line_no"),
        (F.col("host_id") + F.col("_copy") * 16).alias("host_id"), "value",
    )
    lines = materialize(raw.repartition(int(cpus) * 2), "bench-lines")
    table = materialize(parse_lines(lines).drop("cpu_cores"), "bench-entries")
    block = {"block_rows": max(4096, n * copies // (4 * int(cpus)))}
    model = forest.fit_forest(table, ["line_no"])

    def sink(df):
        df.write.format("noop").mode("overwrite").save()

    streams = itertools.count()

    def stream_baseline():
        """The entries as 20 files, one a batch, through the stateful baseline."""
        folder = f"{shared_root(spark)}/bench-stream"
        if not next(streams):
            table.select("host_id", "line_no", "cpu_max_pct", "mem_used_pct").repartition(20, "line_no").write.mode("overwrite").parquet(f"{folder}/in")
        here = f"{folder}/{next(streams)}"
        rows = spark.read.parquet(f"{folder}/in")
        arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        baseline.run_stateful(arriving, "host_id", f"{here}/out", f"{here}/progress").awaitTermination()

    jobs = {
        "parse_lines": lambda: sink(parse_lines(lines)),
        "parse_tally": lambda: stats.parse_tally(with_parse(lines)).collect(),
        "stats_summary": lambda: stats.stats_summary(table).collect(),
        "type_breakdown": lambda: stats.type_breakdown(table).collect(),
        "page": lambda: paging.page_of_records(table, 3, 50, "anomaly").collect(),
        "top_recent_per_host": lambda: sink(paging.last_per_stream(table, "host_id")),
        "rolling_per_host": lambda: sink(
            rolling.smart_alerts(table, reason=False, stream_key="host_id", **block)
        ),
        "rolling_one_stream": lambda: sink(rolling.smart_alerts(table, reason=False, **block)),
        "compare_detectors": lambda: evaluate.compare_detectors(
            rolling.detections(table, **block)
        ).collect(),
        "lines_to_comparison": lambda: evaluate.compare_detectors(
            rolling.detections(parse_lines(lines), **block)
        ).collect(),
        "forest_fit": lambda: forest.fit_forest(table, ["line_no"]),
        "forest_score": lambda: sink(forest.with_score(table, model)),
        "scored_history": lambda: sink(scoring.scored_history(table, model, **block)),
        "stream_baseline": stream_baseline,
    }
    times = {}
    for name, job in jobs.items():
        job()
        start = time.perf_counter()
        job()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]} s", file=sys.stderr, flush=True)
    total = lines.count()
    print(
        json.dumps(
            {
                "metric": "headline_jobs_total", "value": round(sum(times.values()), 3),
                "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "lines": total, "parse_lines_per_sec": round(total / times["parse_lines"]),
            }
        )
    )


if __name__ == "__main__":
    main()
