from vigilog.sources.replay import replay_lines
from vigilog.storage import scratch_path
from vigilog.streaming.progress import ProgressTable, rates, read_progress


def test_rows_of_each_batch_are_kept_over_a_restart(spark):
    inbox, out, progress, folder = (scratch_path(spark, x) for x in ("in", "out", "checkpoint", "progress"))
    table = ProgressTable(spark, folder)
    spark.streams.addListener(table)
    try:
        for n in (30, 50):
            spark.range(n).selectExpr("id as line_no", "'x' as value").repartition(2).write.mode("append").parquet(inbox)
            query = (
                replay_lines(spark, inbox, max_files=1).writeStream.format("parquet").option("path", out)
                .option("checkpointLocation", progress).trigger(availableNow=True).start()
            )
            query.awaitTermination()
            assert table.finish(query)
    finally:
        spark.streams.removeListener(table)
    found = read_progress(spark, folder).collect()
    assert sorted(r.batch for r in found) == [0, 1, 2, 3] and sum(r.rows for r in found) == 80
    total = rates(read_progress(spark, folder)).collect()
    assert len(total) == 1 and (total[0].batches, total[0].rows, total[0].state_rows) == (4, 80, 0)
    assert total[0].rows_per_second > 0 and total[0].longest_ms > 0
