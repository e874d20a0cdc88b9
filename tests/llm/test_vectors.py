import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_text import slow_components
from vigilog.llm import polytope, topk
from vigilog.llm.vectors import usable

SCHEMA = "vec_id long, v array<double>, component_id string, score string, _x string"


def unit_rows():
    rng = np.random.default_rng(12)
    rows = []
    for c in range(4):
        centre = rng.normal(size=24)
        rows += [(centre + 0.2 * rng.normal(size=24) * rng.random()).tolist() for _ in range(30)]
    rows += [rng.normal(size=24).tolist() for _ in range(60)]
    rows += [rows[0], rows[0], [2 * x for x in rows[1]], [1e-200 * x for x in rows[2]], [1e200 * x for x in rows[3]]]
    data = [(i, v) for i, v in enumerate(rows)]
    data += [(None, rows[5]), (7, rows[7]), (900, None), (901, []), (902, [0.0] * 24), (903, [math.nan] * 24), (904, [math.inf] * 24), (905, rows[4][:23]), (906, [None] * 24)]
    return [(k, v, "own", "own", "own") for k, v in data]


def valid(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute_links(rows, cosine):
    def cos(a, b):
        a, b = ([x / max(map(abs, v)) for x in v] for v in (a, b))
        return math.fsum(x * y for x, y in zip(a, b)) / math.sqrt(math.fsum(x * x for x in a)) / math.sqrt(math.fsum(x * x for x in b))

    return [
        (i, j) for i in range(len(rows)) for j in range(i)
        if valid(rows[i][1]) and valid(rows[j][1]) and len(rows[i][1]) == len(rows[j][1]) and cos(rows[i][1], rows[j][1]) >= cosine
    ]


def check(spark, rows):
    got = polytope.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), vector="v")
    assert {(r.score, r._x) for r in got.select("score", "_x").collect()} == {("own", "own")}
    edges = brute_links(rows, 0.95)
    labels = slow_components(len(rows), edges)
    degree = np.bincount([x for e in edges for x in e], minlength=len(rows))
    least = {}
    for (key, *_), label in zip(rows, labels):
        if key is not None:
            least[label] = min(least.get(label, key), key)
    want = sorted((str(k), int(d), str(least.get(x) if valid(v) else k)) for (k, v, *_), d, x in zip(rows, degree, labels))
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got.collect()) == want
    assert degree.sum() > 500


def test_near_vectors(spark):
    check(spark, unit_rows())


def test_near_vectors_in_cells(spark, monkeypatch):
    monkeypatch.setattr(polytope, "CELL", 8)
    check(spark, unit_rows())


def test_no_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert polytope.near_vectors(none, vector="v").collect() == []
    assert topk.top_inner_products(none, none, vector="v").collect() == []


def test_recall_at_the_bound():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    y = 0.95 * x + math.sqrt(1 - 0.95**2) * z
    a, b = polytope.bucket_keys(x), polytope.bucket_keys(y)
    met = (a[:, :, :, None] == b[:, :, None, :]).any(axis=(1, 2, 3))
    assert met.mean() > 0.999
    other = (a[:2000, :, :, None] == b[2000:, :, None, :]).any(axis=(1, 2, 3))
    assert other.mean() < 0.01


def whole_rows(n=700, dims=12):
    rng = random.Random(14)
    rows = [(i, [float(rng.randint(-9, 9)) * rng.choice([1, 1, 5]) for _ in range(dims)]) for i in range(n)]
    rows += [(n + i, rows[i][1]) for i in range(40)] + [(3, rows[3][1]), (5000, None), (5050, [math.nan] * dims), (5100, [1.0] * 5), (5150, [0.0] * dims), (None, rows[0][1])]
    return [(k, v, "own", "own", "own") for k, v in rows]


def brute_top(rows, k):
    usable_rows = [(key, v) for key, v, *_ in rows if key is not None and v and all(math.isfinite(x) for x in v)]
    asked = {}
    for key, v in usable_rows:
        if key % 50 == 0:
            asked.setdefault(key, v)
    out = set()
    for key, q in asked.items():
        held = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
        scored = sorted((-held(sum(int(a) * int(b) for a, b in zip(q, v))), other) for other, v in usable_rows if other != key and len(v) == len(q))
        out |= {(key, r + 1, other, -s) for r, (s, other) in enumerate(scored[:k])}
    return out


def few_at_a_time(monkeypatch):
    for name, size in (("SLICE", 64), ("QUERY_BLOCK", 4), ("STEP", 16), ("QUERIES", 6), ("LONGEST", 20)):
        monkeypatch.setattr(topk, name, size)


@pytest.mark.parametrize("small", [False, True])
def test_top_inner_products(spark, monkeypatch, small):
    if small:
        few_at_a_time(monkeypatch)
    rows = whole_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute_top(rows, 5)
    got = topk.top_inner_products(df, df.where("vec_id % 50 = 0"), vector="v").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("small", [False, True])
def test_scores_of_any_size(spark, monkeypatch, small):
    """Exact where 64 bits hold them, else the limits of a long; none is lost."""
    if small:
        few_at_a_time(monkeypatch)
    rng = random.Random(15)
    sizes = [1.0, 3.0e6, 1.2e7 * 256, 2.0**31 + 1, 2.0**52 + 2, 2e20, 1e30, 1e160, 1e308]
    rows = [(i, [rng.choice([0.0, 0.0, 1.0, -1.0]) * math.floor(min(rng.choice(sizes) * rng.choice([1, 1, 7]), 1.7e308)) for _ in range(6)]) for i in range(400)]
    rows += [(1000, [1e30, 1.0]), (1001, [0.0, 5.0]), (1002, [2e20, 3e18]), (1050, [0.0, 1e30]), (1003, [1.0, -2.0]), (1004, [-1e30, 0.0])]
    rows = [(k, v, "own", "own", "own") for k, v in rows]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = topk.top_inner_products(df, df.where("vec_id % 50 = 0"), vector="v").collect()
    want = brute_top(rows, 5)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert {s for *_, s in want} & {(1 << 63) - 1} and (1000, 4, 1001, 5) in want


def test_rows_that_cannot_be_reached_are_not_sent(spark, monkeypatch):
    """A few long rows decide; the many short ones of later slices are neither copied nor asked."""
    monkeypatch.setattr(topk, "SLICE", 100)
    monkeypatch.setattr(topk, "QUERIES", 40)
    rng = np.random.default_rng(16)
    x = rng.integers(-3, 4, (3000, 8)).astype(float)
    x[:90] += rng.choice([-400, 400], (90, 8))
    order = rng.permutation(3000)
    df = spark.createDataFrame([(int(i), x[j].tolist(), "", "", "") for i, j in enumerate(order)], SCHEMA)
    asked = df.where("vec_id % 50 = 0")
    sent = []
    monkeypatch.setattr(topk, "_meet", lambda meetings, turn, k, meet=topk._meet: sent.append(meetings) or meet(meetings, turn, k))
    got = topk.top_inner_products(df, asked, vector="v").collect()
    assert {tuple(r) for r in got} == brute_top([tuple(r) for r in df.collect()], 5)
    count = {asks: n for asks, n in sent[0].groupBy("_asks").count().collect()}
    # 60 queries in 2 groups, 30 slices: all pairs would be 6,000 rows and 1,800 queries.
    assert count[True] <= 60 * 3 and count[False] <= 2 * 300


def test_usable(spark):
    df = spark.createDataFrame([(v,) for _, v, *_ in unit_rows()], "v array<double>").select("v", usable(F.col("v")).alias("u"))
    assert all(r.u == (bool(r.v) and all(x is not None and math.isfinite(x) for x in r.v)) for r in df.collect())
