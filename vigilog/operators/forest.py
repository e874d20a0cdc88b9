"""Isolation Forest as Spark jobs (Liu, Ting and Zhou, 2008).

Training needs 256 rows per tree, whatever the size of the table: one scan for
the scaler, one that draws each tree's rows by hash, and one tree per group. Scoring is a map over the table with the node table broadcast; its size
is bounded by trees x (2 x sample - 1) nodes.
"""

import math
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.functions.draws import uniform
from vigilog.functions.numeric import round_exact
from vigilog.functions.settle import settle
from vigilog.operators.labels import fill_features, verdict
from vigilog.operators.quantiles import exact_quantile
from vigilog.schema import CONTAMINATION, FEATURES, N_TREES, SAMPLE_SIZE, SEED
from vigilog.storage import materialize, scratch

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, "
    "path double, size int"
)


@dataclass(frozen=True)
class ForestModel:
    """Scaler rows, node rows and settings (with the decision offset)."""

    scaler: DataFrame
    nodes: DataFrame
    meta: dict


# --- scaling ---------------------------------------------------------------


def fit_scaler(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """``feature, mean, scale``: population deviation, 1 where a column is constant."""
    stats = fill_features(df, features).agg(
        *[f(c).alias(f"{n}_{c}") for c in features for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"), F.lit(c).alias("feature"),
                F.col(f"m_{c}").alias("mean"),
                F.when(F.col(f"s_{c}") == 0, 1.0).otherwise(F.col(f"s_{c}")).alias("scale"),
            )
            for i, c in enumerate(features)
        ]
    )
    return stats.select(F.inline(rows))


def scaler_values(scaler: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and scale by feature; the scaler has one row per feature."""
    return {r.feature: (r.mean, r.scale) for r in scaler.collect()}


def scaled_feature(name: str, fixed: dict[str, tuple[float, float]]) -> Column:
    """(x - mean) / scale, a missing x counting as 0."""
    mean, scale = fixed[name]
    x = F.coalesce(F.nanvl(F.col(name), F.lit(0.0)), F.lit(0.0))
    return (x - F.lit(mean)) / F.lit(scale)


def apply_scaler(df: DataFrame, scaler: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Replace the features by their scaled values."""
    fixed = scaler_values(scaler)
    return df.withColumns({c: scaled_feature(c, fixed) for c in features})


# --- training --------------------------------------------------------------


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search in a binary tree of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def grow_tree(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Node rows of one tree: random feature among those that vary, random cut."""
    nodes, todo = [], [(0, np.arange(len(x)), 0)]
    used = 1
    while todo:
        node, rows, depth = todo.pop()
        part = x[rows]
        lo, hi = part.min(axis=0), part.max(axis=0)
        varying = np.flatnonzero(lo < hi)
        if depth >= limit or not len(varying):
            nodes.append((node, -1, None, None, None, depth + average_path(len(rows)), len(rows)))
            continue
        f = int(rng.choice(varying))
        cut = float(rng.uniform(lo[f], hi[f]))
        cut = cut if cut < hi[f] else float(lo[f])
        goes_left = part[:, f] <= cut
        nodes.append((node, f, cut, used, used + 1, None, len(rows)))
        todo.append((used + 1, rows[~goes_left], depth + 1))
        todo.append((used, rows[goes_left], depth + 1))
        used += 2
    return nodes


def _tree_samples(rows: DataFrame, ids: list[str], rate: float, size: int, trees: int, seed: int) -> DataFrame:
    """``size`` rows per tree out of all rows: each tree draws every row with chance ``rate``.

    One hash of a row decides whether any tree draws it and, if so, which is the first
    (a geometric skip); only then are the later trees' draws made. Of what a tree drew,
    the lowest hashes stay. The work beyond that one hash is bounded by trees and size.
    """
    keys = [F.col(c) for c in ids]
    miss = 1.0 - rate
    u = uniform(keys, seed)
    any_tree = 1.0 - miss**trees
    first = F.least(F.lit(trees - 1), F.floor(F.log1p(-F.col("_u")) / F.lit(math.log(miss)))).cast("int") if rate < 1.0 else F.lit(0)
    drawn = rows.withColumn("_u", u).where(F.col("_u") < any_tree).withColumn("_first", first)
    later = drawn.withColumn("tree", F.explode(F.sequence(F.col("_first"), F.lit(trees - 1))))
    own = (F.col("tree") == F.col("_first")) | (uniform([*keys, F.col("tree")], seed + 1) < rate)
    lowest = Window.partitionBy("tree").orderBy(uniform([*keys, F.col("tree")], seed + 2), *ids)
    return later.where(own).withColumn("_n", F.row_number().over(lowest)).where(F.col("_n") <= size).drop("_u", "_first")


def fit_nodes(
    scaled: DataFrame, ids: list[str], rows: int, features: list[str] = FEATURES,
    trees: int = N_TREES, sample: int = SAMPLE_SIZE, seed: int = SEED,
) -> DataFrame:
    """The node table of a forest over ``rows`` scaled rows, identified by ``ids``.

    Every tree takes its own sample of the whole table without replacement, in one scan
    that is the same at any size. If chance leaves a tree short of rows, the draw is
    repeated at a higher rate, at last over all rows.
    """
    size = min(sample, rows)
    limit = math.ceil(math.log2(max(size, 2)))
    # So many drawn rows fall short of ``size`` less than once in 10^9 trees.
    rate = min(1.0, (1.6 * size + 40) / rows)

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        ordered = group.sort_values("_n")
        rng = np.random.default_rng([seed, tree])
        grown = grow_tree(ordered[features].to_numpy(float), rng, limit)
        out = pd.DataFrame(
            grown, columns=["node", "feature", "threshold", "left", "right", "path", "size"]
        )
        out.insert(0, "tree", tree)
        return out.astype({"left": "Int32", "right": "Int32"})

    while True:
        nodes = materialize(
            _tree_samples(scaled.select(*ids, *features), ids, rate, size, trees, seed)
            .groupBy("tree")
            .applyInPandas(grow, NODE_SCHEMA),
            "forest-nodes",
        )
        full = nodes.where((F.col("node") == 0) & (F.col("size") == size)).count()
        if full == trees:
            return nodes
        if rate == 1.0:
            raise ValueError(f"row ids {ids} do not identify the rows")
        rate = min(1.0, 4 * rate)


def fit_forest(
    df: DataFrame, ids: list[str], features: list[str] = FEATURES, trees: int = N_TREES,
    sample: int = SAMPLE_SIZE, contamination: float = CONTAMINATION, seed: int = SEED,
) -> ForestModel:
    """Scaler, trees and decision offset over all rows of ``df`` (no labels used).

    ``df`` is scanned three times; pass a stored table. The offset is the exact
    ``contamination`` quantile of the training scores.
    """
    total = df.count()
    if not total:
        raise ValueError("no rows to train on")
    with scratch(df.sparkSession):
        return _fit(df, ids, total, features, trees, sample, contamination, seed)


def _held(df: DataFrame) -> DataFrame:
    """A small table by value; the folder it came from is not needed any more."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def _fit(df, ids, total, features, trees, sample, contamination, seed) -> ForestModel:
    # A row for each feature, and at most trees x (2 x sample - 1) nodes.
    scaler = _held(fit_scaler(df, features))
    scaled = apply_scaler(df, scaler, features)
    nodes = _held(fit_nodes(scaled, ids, total, features, trees, sample, seed))
    model = ForestModel(
        scaler,
        nodes,
        {
            "rows": total, "sample": min(sample, total), "trees": trees, "seed": seed,
            "contamination": contamination, "features": list(features), "offset": None,
        },
    )
    scores = materialize(with_score(df, model).select("score"), "scores")
    offset = exact_quantile(scores, "score", contamination)
    return replace(model, meta={**model.meta, "offset": offset})


# --- scoring ---------------------------------------------------------------


def _node_arrays(nodes: DataFrame, trees: int, sample: int) -> tuple:
    """Trees as complete binary trees: feature, cut and leaf path by heap position.

    The root is at 1, the children of ``i`` at ``2i`` and ``2i + 1``. A leaf above
    the last level is repeated below itself, so that every row takes the same
    number of steps. All trees are laid out level by level.
    """
    depth = math.ceil(math.log2(max(sample, 2)))
    inner = 2**depth
    feature = np.zeros((trees, inner), np.intp)
    cut = np.full((trees, inner), np.inf)
    path = np.zeros((trees, inner))
    bound = trees * (2 * sample - 1)
    rows = nodes.limit(bound + 1).toPandas()
    if len(rows) > bound:
        raise ValueError("node table is larger than its model allows")
    rows = rows.sort_values(["tree", "node"])
    start = np.searchsorted(rows["tree"], np.arange(trees))
    column = {c: rows[c].to_numpy() for c in ("feature", "threshold", "path")}
    child = {c: rows[c].fillna(0).to_numpy(np.intp) for c in ("left", "right")}
    tree, at, node = np.arange(trees), np.ones(trees, np.intp), start.copy()
    while len(node):
        split = column["feature"][node] >= 0
        leaf_tree, leaf_at = tree[~split], at[~split]
        while (leaf_at < inner).any():
            leaf_at = np.where(leaf_at < inner, 2 * leaf_at, leaf_at)
        path[leaf_tree, leaf_at - inner] = column["path"][node[~split]]
        tree, at, node = tree[split], at[split], node[split]
        feature[tree, at], cut[tree, at] = column["feature"][node], column["threshold"][node]
        node = np.concatenate([start[tree] + child[c][node] for c in ("left", "right")])
        at = np.concatenate([2 * at, 2 * at + 1])
        tree = np.concatenate([tree, tree])
    return feature, cut, path, depth


CHUNK = 16_384


def mean_path(x: np.ndarray, feature, cut, path, depth: int) -> np.ndarray:
    """Mean leaf path over all trees; rows advance together, a chunk at a time."""
    out = np.empty(len(x))
    inner = feature.shape[1]
    for lo in range(0, len(x), CHUNK):
        part = np.ascontiguousarray(x[lo : lo + CHUNK])
        n, width = part.shape
        flat, base = part.ravel(), np.arange(n) * width
        at, where = np.empty(n, np.intp), np.empty(n, np.intp)
        value, limit, total = np.empty(n), np.empty(n), np.zeros(n)
        for f, c, p in zip(feature, cut, path):
            at.fill(1)
            for _ in range(depth):
                np.take(f, at, out=where, mode="clip")
                np.add(where, base, out=where)
                np.take(flat, where, out=value, mode="clip")
                np.take(c, at, out=limit, mode="clip")
                np.add(at, at, out=at)
                np.add(at, value > limit, out=at)
            total += p[at - inner]
        out[lo : lo + n] = total / len(feature)
    return out


def with_score(df: DataFrame, model: ForestModel) -> DataFrame:
    """Add ``score`` = -2^(-mean path / expected path), in (-1, 0); lower is odder."""
    meta = model.meta
    features = meta["features"]
    shared = df.sparkSession.sparkContext.broadcast(
        _node_arrays(model.nodes, meta["trees"], meta["sample"])
    )
    norm = average_path(meta["sample"]) or 1.0

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(float) for c in columns])
        return pd.Series(-np.exp2(-mean_path(x, *shared.value) / norm))

    # The scaled features are the UDF's arguments; the entry keeps its own values.
    fixed = scaler_values(model.scaler)
    scored = df.withColumn("score", score(*[scaled_feature(c, fixed) for c in features]))
    return settle(scored, "score")


def iso_flag(score: Column, offset: float) -> Column:
    """-1/+1 decision of the forest as 1/0: anomalous below the offset."""
    return F.when(decision(score, offset) == -1, 1).otherwise(0)


def decision(score: Column, offset: float) -> Column:
    return F.when(score < offset, -1).otherwise(1)


def with_verdict(scored: DataFrame, offset: float) -> DataFrame:
    """Forest or smart alert; ``score`` shown with 4 decimals, decided unrounded.

    ``scored`` has ``score``, ``smart_alert`` and ``smart_reason``.
    """
    flagged = scored.withColumn("iso_anomaly", iso_flag(F.col("score"), offset))
    return (
        flagged.withColumn(
            "is_anomaly",
            ((F.col("iso_anomaly") == 1) | (F.col("smart_alert") == 1)).cast("int"),
        )
        .withColumn("label", verdict(F.col("is_anomaly")))
        .withColumn("score", round_exact("score", 4))
    )
