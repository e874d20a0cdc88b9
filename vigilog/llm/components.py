"""Connected components, and group-wise work in which no task gets an unbounded group."""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vigilog.storage import materialize


def connected(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every end of the edges ``(a, b)``; a component is its smallest id.

    Large-star and small-star steps in turn, each a shuffle of the edges that are left, so
    that long chains shrink by half or more a round. Steps are written to the shared
    folder, which cuts the lineage and lets Spark split a hub's partition in the join.
    """
    down, mark = _kept(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while mark[0]:
        # Large star: what lies above b is tied to the least neighbour of b.
        of_b = materialize(down.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("m")), "least")
        large = materialize(down.join(of_b, "b", "left").select("a", F.coalesce("m", "b").alias("b")).distinct(), "large")
        # Small star: what lies below a, and a, are tied to the least neighbour of a.
        of_a = large.groupBy("a").agg(F.min("b").alias("m"))
        below = large.join(of_a, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down, now = _kept(below.unionByName(of_a.select("a", F.col("m").alias("b"))).distinct(), "edges")
        if now == mark:
            break
        mark = now
    roots = down.select(F.col("b").alias("id")).distinct()
    return down.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))


def _kept(edges: DataFrame, label: str) -> tuple[DataFrame, tuple]:
    """The edges, written, and what tells whether they changed: their number and a sum of hashes."""
    seen = Observation()
    mark = F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 32)))
    kept = materialize(edges.observe(seen, F.count(F.lit(1)).alias("n"), mark.alias("sum")), label)
    return kept, (seen.get["n"], seen.get["sum"])


def in_cells(rows: DataFrame, key: str, parts: Column, member: Column) -> DataFrame:
    """Splits groups of ``key`` into ``parts`` cells and repeats a row for each pair of cells it is in.

    Adds ``_i`` and ``_j``; rows of one (key, _i, _j) meet, and any two rows of a key meet in
    at least one pair. A group of one part has the pair (0, 0). Rows grow with the number
    of cells of a group, never with the pairs of its rows.
    """
    celled = rows.withColumn("_parts", parts.cast("int")).withColumn("_cell", F.pmod(F.xxhash64(member), F.col("_parts")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("_parts") - 1), lambda j: j != F.col("_cell"))
    pairs = F.when(F.col("_parts") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(others, lambda j: F.struct(F.least(j, F.col("_cell")).alias("i"), F.greatest(j, F.col("_cell")).alias("j")))
    )
    paired = celled.withColumn("_pair", F.explode(pairs))
    return paired.select(*rows.columns, F.col("_pair.i").alias("_i"), F.col("_pair.j").alias("_j"))


def by_group(rows: DataFrame, keys: list[str], work: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``work`` on every group of ``keys``; many small groups cost little.

    Groups are brought together by a shuffle and a sort and cut out of the sorted batches,
    so a task holds a batch and one group at a time.
    """
    def cut(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        for pdf in frames:
            if not len(pdf):
                continue
            held = [pdf[k].to_numpy() for k in keys]
            new = np.zeros(len(pdf), bool)
            for h in held:
                new[1:] |= h[1:] != h[:-1]
            new[0] = not waiting or any(waiting[-1][k].iloc[-1] != pdf[k].iloc[0] for k in keys)
            starts = np.flatnonzero(new).tolist()
            if not starts:
                waiting.append(pdf)
                continue
            if starts[0] and waiting or waiting:
                waiting.append(pdf.iloc[: starts[0]])
                yield work(pd.concat(waiting, ignore_index=True))
            for a, b in zip(starts, starts[1:]):
                yield work(pdf.iloc[a:b])
            waiting = [pdf.iloc[starts[-1] :]]
        if waiting:
            yield work(pd.concat(waiting, ignore_index=True))

    def gathered(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        some, n = [], 0
        for found in cut(frames):
            if len(found):
                some.append(found)
                n += len(found)
            if n > 20_000:
                yield pd.concat(some, ignore_index=True)
                some, n = [], 0
        if some:
            yield pd.concat(some, ignore_index=True)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(gathered, schema)


def by_small_group(
    rows: DataFrame, keys: list[str], work: Callable[[dict[str, np.ndarray]], tuple[np.ndarray, ...] | None], schema: str, names: list[str]
) -> DataFrame:
    """As ``by_group`` for very many groups of a few rows: ``work`` gets plain arrays by column
    name and returns arrays by ``names``, or nothing. Groups of one row are passed over."""
    columns = rows.columns

    def cut(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[str, np.ndarray] | None = None
        for pdf in frames:
            if not len(pdf):
                continue
            held = {c: pdf[c].to_numpy() for c in columns}
            if waiting is not None:
                held = {c: np.concatenate([waiting[c], held[c]]) for c in columns}
            n = len(held[keys[0]])
            new = np.zeros(n, bool)
            for k in keys:
                new[1:] |= held[k][1:] != held[k][:-1]
            starts = [0, *np.flatnonzero(new).tolist()]
            # The last group may go on in the next batch.
            waiting = {c: v[starts[-1] :] for c, v in held.items()}
            yield from found(held, starts)
        if waiting is not None:
            yield from found(waiting, [0, len(waiting[keys[0]])])

    def found(held: dict[str, np.ndarray], starts: list[int]) -> Iterator[pd.DataFrame]:
        some = [f for a, b in zip(starts, starts[1:]) if b - a > 1 and (f := work({c: v[a:b] for c, v in held.items()})) is not None]
        if some:
            yield pd.DataFrame({n: np.concatenate(x) for n, x in zip(names, zip(*some))})

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(cut, schema)


class Sets:
    """Union-find over 0 to n - 1."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y

    def labels(self) -> np.ndarray:
        return np.fromiter((self.find(x) for x in range(len(self.parent))), np.int64, len(self.parent))
