import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from vigilog.operators import evaluate, paging, rolling, stats


def labelled(spark, tn, fp, fn, tp):
    rows = [(0, 0)] * tn + [(0, 1)] * fp + [(1, 0)] * fn + [(1, 1)] * tp
    return spark.createDataFrame(rows, "is_anomaly int, predicted int")


def test_published_quality_figures(spark):
    df = labelled(spark, 45, 0, 2, 3)
    r = {x["class"]: x for x in evaluate.classification_report(df).collect()}
    assert r["accuracy"].f1 == pytest.approx(0.96) and r["accuracy"].support == 50
    assert r["macro avg"].precision == pytest.approx((45 / 47 + 1) / 2)
    assert r["macro avg"].recall == pytest.approx(0.80)
    assert (r["Normal"].support, r["Anomaly"].support) == (45, 5)
    assert r["weighted avg"].recall == pytest.approx(0.96)


def test_report_without_any_alert(spark):
    r = {x["class"]: x for x in evaluate.classification_report(labelled(spark, 4, 0, 1, 0)).collect()}
    assert (r["Anomaly"].precision, r["Anomaly"].recall, r["Anomaly"].f1) == (0.0, 0.0, 0.0)


def test_flagship_figures(spark, table):
    got = evaluate.compare_detectors(rolling.detections(table, block_rows=128)).first()
    assert (got.total, got.labelled, got.smart_tp, got.smart_fp, got.static_tp, got.static_fp) == (920, 40, 40, 28, 40, 0)
    alerts = rolling.detections(table).where("smart_alert = 1").agg({"line_no": "sum"}).first()[0]
    assert alerts == 34173


def test_empty_tables(spark, table):
    none = table.limit(0)
    assert stats.entry_counts(none).count() == 0
    s = stats.stats_summary(none).first()
    assert (s.total, s.anomalies, s.anomaly_pct, s.cpu_avg, s.anomaly_types) == (0, 0, 0.0, None, {})
    assert paging.page_counts(none).first().asDict() == {"total": 0, "pages": 1}
    assert paging.page_of_records(none).count() == 0
    assert paging.page_of_records(none, 3, 10, shallow_rows=0).count() == 0
    assert evaluate.compare_detectors(rolling.detections(none)).first().total == 0


def test_pages(spark, table):
    with pytest.raises(ValueError):
        paging.page_of_records(table, 0)
    with pytest.raises(ValueError):
        paging.page_counts(table, 0)
    assert paging.page_of_records(table, 19, 50).count() == 20
    assert paging.page_of_records(table, 20, 50).count() == 0
    for page in (1, 4, 19, 20):
        a = paging.page_of_records(table, page, 50).collect()
        assert a == paging.page_of_records(table, page, 50, shallow_rows=-1).collect()


def test_top_process(spark):
    rows = [
        ("a", 5, "x", 1.0), ("a", 3, "y", 9.0), ("a", 2, "z", 9.0), ("a", 9, "n", None),
        ("b", 7, "n", None), ("b", 8, "m", None),
    ]
    df = spark.createDataFrame(rows, "host string, pid bigint, name string, cpu_percent double")
    got = {r.host: r.top_proc for r in paging.top_process(df, ["host"]).collect()}
    assert got == {"a": "pid=2 name=z cpu=9.0%", "b": "pid=7 name=n cpu=None%"}


def test_last_readings_are_cut_before_the_shuffle(spark, table):
    df = paging.last_per_stream(table, "host_id", 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.index("Partial") > plan.index("Exchange")
    assert df.count() == 3 * table.select("host_id").distinct().count()


@pytest.mark.parametrize("kind", ["string", "timestamp", "double", "date"])
def test_deep_pages_on_any_order_column(spark, kind):
    """Ties, nulls and a page beyond the end; only the range of the wanted rank is ordered."""
    x = {
        "string": "concat('k', id % 37)", "timestamp": "timestamp_seconds(id % 37 * 1000)", "double": "id % 37 / 8D", "date": "date_add(date'2026-01-01', cast(id % 37 as int))",
    }[kind]
    df = spark.range(500).selectExpr("id", f"case when id % 50 <> 3 then {x} end as at", "cast(id % 2 as int) as is_anomaly").repartition(3)
    for which in ("all", "anomaly"):
        for page in (1, 2, 9, 17, 60):
            deep = paging.page_of_records(df, page, 30, which, ["at", "id"], shallow_rows=-1).collect()
            assert deep == paging.page_of_records(df, page, 30, which, ["at", "id"]).collect()


@pytest.mark.parametrize("order", [["at", "x"], ["x"], ["name", "at"]])
def test_wide_pages_are_the_same_pages_in_many_tasks(spark, order):
    """Ties, nulls, NaN, both zeros, and copies that lie across the end of a page."""
    df = spark.range(600).repartition(3).selectExpr(
        "case when id % 50 <> 3 then id % 7 end as at",
        "case when id % 31 = 0 then double('nan') when id % 29 = 0 then null when id % 23 = 0 then -0.0D else id % 5 / 8D end as x",
        "case when id % 11 <> 2 then concat('k', id % 3) end as name",
        "cast(id % 2 as int) as is_anomaly",
        "if(id % 3 = 0, 0, id) as copy",
    )
    whole = df.orderBy(*order, F.xxhash64(*df.columns)).collect()
    text = lambda rows: [str(r).replace("-0.0", "0.0") for r in rows]
    for page, size in ((2, 250), (3, 250), (4, 250)):
        wide = paging.page_of_records(df, page, size, order_col=order, wide_rows=0)
        assert text(wide.collect()) == text(whole[(page - 1) * size : page * size]), (page, size)
    anomalies = [r for r in whole if r.is_anomaly == 1]
    assert text(paging.page_of_records(df, 2, 70, "anomaly", order, wide_rows=0).collect()) == text(anomalies[70:140])


def test_copies_across_the_end_of_a_wide_page(spark):
    df = spark.range(500).selectExpr("5L as line_no", "0 as is_anomaly", "if(id < 480, 0, id) as x").repartition(4)
    pages = [paging.page_of_records(df, p, 150, wide_rows=0) for p in (1, 2, 3, 4, 5)]
    assert [p.count() for p in pages] == [150, 150, 150, 50, 0]
    got = pages[0].unionByName(pages[1]).unionByName(pages[2]).unionByName(pages[3])
    assert got.exceptAll(df).count() == 0 and df.exceptAll(got).count() == 0


def test_a_wide_page_has_no_task_for_all_its_rows(spark):
    df = spark.range(60_000).selectExpr("id % 500 as line_no", "0 as is_anomaly", "id").repartition(4)
    page = paging.page_of_records(df, 2, 20_000)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "SinglePartition" not in plan
    rows = page.collect()
    assert [r.line_no for r in rows] == sorted(r.line_no for r in rows)
    assert len(rows) == 20_000 and (rows[0].line_no, rows[-1].line_no) == (166, 333)
