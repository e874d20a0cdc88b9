"""Exact top-k inner products: norm-sorted slices, SVD-rotated partial sums, Cauchy-Schwarz bounds."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilog.llm.frame import col
from vigilog.llm.vectors import doubles, matrix, packed, usable
from vigilog.storage import materialize

QUERY_BLOCK = 1024
# Rows that stay together in a task; slices by length grow beyond it so as to be at most MOST_SLICES.
SLICE, MOST_SLICES = 16384, 100_000
STEP = 1024
HEAD = 16
# Queries that one copy of a slice may meet, and the longest rows that every query meets first.
QUERIES, LONGEST, LONGEST_BYTES = 65_536, 4096, 16 << 20
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def norms(x: np.ndarray) -> np.ndarray:
    """Lengths of rows, without overflow of the squares."""
    most = np.abs(x).max(axis=1, initial=0)
    scale = np.where(most > 0, most, 1)
    with np.errstate(over="ignore"):
        return np.minimum(scale * np.sqrt(((x / scale[:, None]) ** 2).sum(1)), 1e308) * (most > 0)


def rotation(vectors: DataFrame, dims: int) -> np.ndarray:
    """The right singular vectors of all rows, strongest first, from sums of outer products.

    The sums are ``dims`` by ``dims`` whatever the number of rows. Huge components are cut for
    it: any rotation gives right bounds, only not as narrow ones.
    """
    def gram(frames):
        total = np.zeros((dims, dims))
        for pdf in frames:
            x = np.clip(matrix(pdf["_x"]), -1e100, 1e100)
            total += x.T @ x
        yield pd.DataFrame({"i": np.repeat(np.arange(dims), dims), "j": np.tile(np.arange(dims), dims), "v": total.reshape(-1)})

    sums = vectors.select("_x").mapInPandas(gram, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    total = np.zeros((dims, dims))
    total[sums["i"], sums["j"]] = sums["v"]
    values, vectors_ = np.linalg.eigh(total)
    return vectors_[:, np.argsort(-values, kind="stable")]


def product(a: np.ndarray, b: np.ndarray) -> int:
    """The inner product in whole numbers, held to 64 bits."""
    return min(max(sum(int(x) * int(y) for x, y in zip(a, b)), LEAST), MOST)


class Rows:
    """Rows by falling length, against which blocks of queries are scored."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, turn: np.ndarray):
        length = norms(x)
        order = np.lexsort((ids, -length))
        self.x, self.ids, self.length, self.turn = x[order], ids[order], length[order], turn
        self.head = min(HEAD, x.shape[1])
        with np.errstate(all="ignore"):
            self.turned = self.x @ turn
            self.whole = self.x.astype(np.int64)
        self.rest = norms(self.turned[:, self.head :]) if self.head < x.shape[1] else np.zeros(len(x))

    def best(self, queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best rows for each query, as (query, id, score), none under its floor.

        Steps of rows are bounded by Cauchy-Schwarz twice: by the lengths, and by the product
        of the first ``HEAD`` rotated components plus that of the lengths of the rest. What
        may still reach a query's k-th score is computed exactly, in whole numbers; bounds
        that are no number prune nothing.
        """
        with np.errstate(all="ignore"):
            turned = queries @ self.turn
            whole = queries.astype(np.int64)
        length = norms(queries)
        rest = norms(turned[:, self.head :]) if self.head < queries.shape[1] else np.zeros(len(queries))
        floor = floor.copy()
        kept_q, kept_x, kept_s = [np.empty(0, np.int64)] * 3
        for at in range(0, len(self.x), STEP):
            part = slice(at, at + STEP)
            with np.errstate(all="ignore"):
                # Rounding of the doubles is far below this.
                slack = 1e-9 * length * self.length[at] + 1e-6
                beat = np.where(floor == LEAST, -np.inf, floor.astype(float))
                open_ = np.flatnonzero(~(length * self.length[at] + slack < beat))
                if not len(open_):
                    break
                bound = turned[open_, : self.head] @ self.turned[part, : self.head].T + np.outer(rest[open_], self.rest[part])
                a, b = np.nonzero(~(bound + slack[open_, None] < beat[open_, None]))
            a, b = open_[a], b + at
            other = query_ids[a] != self.ids[b]
            a, b = a[other], b[other]
            scores = np.empty(len(a), np.int64)
            for first in range(0, len(a), 1 << 16):
                some = slice(first, first + (1 << 16))
                scores[some] = np.einsum("ij,ij->i", whole[a[some]], self.whole[b[some]])
            with np.errstate(all="ignore"):
                large = np.flatnonzero(~(length[a] * self.length[b] < 2.0**52))
            for i in large.tolist():
                scores[i] = product(queries[a[i]], self.x[b[i]])
            good = scores >= floor[a]
            kept_q, kept_x, kept_s = (np.concatenate(z) for z in ((kept_q, a[good]), (kept_x, self.ids[b[good]]), (kept_s, scores[good])))
            # ~score falls as score rises, also where -score would overflow.
            order = np.lexsort((kept_x, ~kept_s, kept_q))
            kept_q, kept_x, kept_s = kept_q[order], kept_x[order], kept_s[order]
            starts = np.flatnonzero(np.concatenate([[True], kept_q[1:] != kept_q[:-1]])) if len(kept_q) else np.empty(0, np.int64)
            rank = np.arange(len(kept_q)) - np.repeat(starts, np.diff(np.append(starts, len(kept_q))))
            top, last = rank < k, rank == k - 1
            floor[kept_q[last]] = np.maximum(floor[kept_q[last]], kept_s[last])
            kept_q, kept_x, kept_s = kept_q[top], kept_x[top], kept_s[top]
        return kept_q, kept_x, kept_s


def top_inner_products(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "vector", k: int = 5) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the greatest inner product for each query: query_id, rank, vec_id, score.

    Components must be whole numbers, of any size a double holds; scores are exact, and those
    beyond 64 bits count as the greatest or least long. Ties go to the smaller key, and a query's
    own key is left out. All are returned if there are fewer. Vectors that are null, empty or
    hold null or non-finite components, and rows with a null key, take no part, and only vectors
    of the query's length are its candidates. Repeated rows are candidates each; of repeated
    queries one is answered, that of the least vector. Only the two named columns are read.
    Empty tables give an empty result.

    Rows are sorted by length and cut in slices. Every query first meets the few longest rows,
    in a map over the queries, which sets the score it has to beat. It is then sent to those
    slices only whose greatest length lets it reach that score; a slice is sent once for each
    ``QUERIES`` queries and holds its rows in a task while the queries pass in blocks. Each
    number of components is a search of its own.
    """
    spark = vectors.sparkSession

    def blobs(df: DataFrame, label: str) -> DataFrame:
        rows = df.where(usable(col(vector)) & col(key).isNotNull()).select(col(key).alias("_id"), doubles(df, vector).alias("_v"))

        def pack_rows(frames):
            for pdf in frames:
                x = [np.array(v, float) for v in pdf["_v"]]
                yield pd.DataFrame({
                    "_id": pdf["_id"], "_x": pd.Series([packed(v) for v in x], pdf.index, object),
                    "_dims": [len(v) for v in x], "_length": [float(norms(v[None, :])[0]) for v in x],
                })

        return materialize(rows.mapInPandas(pack_rows, "_id long, _x binary, _dims int, _length double"), label)

    base = blobs(vectors, "vectors")
    asked = blobs(queries, "queries").groupBy("_id").agg(F.min_by(F.struct("_x", "_dims", "_length"), "_x").alias("q")).select("_id", "q.*")
    found = spark.createDataFrame([], "_query long, _id long, _score long")
    for dims, n, wanted in base.groupBy("_dims").agg(F.count(F.lit(1))).join(asked.groupBy("_dims").agg(F.count(F.lit(1)).alias("q")), "_dims").collect():
        rows = base.where(F.col("_dims") == dims)
        turn = spark.sparkContext.broadcast(rotation(rows, dims))
        floors = materialize(_floors(rows, asked.where(F.col("_dims") == dims), dims, turn, k), "floors")
        found = found.unionByName(_meet(_meetings(rows, n, floors, wanted), turn, k))
    rank = F.row_number().over(Window.partitionBy("_query").orderBy(F.desc("_score"), "_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("_query").alias("query_id"), "rank", F.col("_id").alias("vec_id"), F.col("_score").alias("score"))


def _floors(rows: DataFrame, asked: DataFrame, dims: int, turn, k: int) -> DataFrame:
    """The queries with ``_floor``: their k-th score among the longest rows, a number of rows bounded by count and bytes."""
    few = max(k + 1, min(LONGEST, SLICE, LONGEST_BYTES // (8 * dims)))
    longest = rows.orderBy(F.desc("_length"), "_id").limit(few).select("_id", "_x").toPandas()
    spread = rows.sparkSession.sparkContext.broadcast(longest)

    def first(frames):
        longest = Rows(matrix(spread.value["_x"]), spread.value["_id"].to_numpy(), turn.value)
        for whole in frames:
            for at in range(0, len(whole), QUERY_BLOCK):
                pdf = whole.iloc[at : at + QUERY_BLOCK]
                floor = np.full(len(pdf), LEAST, np.int64)
                q, _, score = longest.best(matrix(pdf["_x"]), pdf["_id"].to_numpy(), floor, k)
                full = np.bincount(q, minlength=len(pdf)) == k
                last = np.append(q[1:] != q[:-1], True) & full[q] if len(q) else np.empty(0, bool)
                floor[q[last]] = score[last]
                yield pdf[["_id", "_x", "_length"]].assign(_floor=floor)

    return asked.select("_id", "_x", "_length").mapInPandas(first, "_id long, _x binary, _length double, _floor long")


def _meetings(rows: DataFrame, n: int, floors: DataFrame, wanted: int) -> DataFrame:
    """What is sent where: rows and queries by ``_slice``, ``_part`` of the slice and ``_group`` of queries.

    A slice is a range of lengths, and falls into parts of about ``SLICE`` rows where ties in length or
    very many rows make it large. Of the slices only number, rows and greatest length reach the driver.
    """
    spark = rows.sparkSession
    slices = min(-(-n // SLICE), MOST_SLICES)
    # Ranges of the length's quantiles, longest first.
    bounds = np.unique(rows.approxQuantile("_length", [1 - i / slices for i in range(1, slices)], 0.2 / slices) if slices > 1 else [])
    edges = spark.sparkContext.broadcast(bounds)

    @F.pandas_udf("int")
    def slice_of(length: pd.Series) -> pd.Series:
        return pd.Series(len(edges.value) - np.searchsorted(edges.value, length.to_numpy(), side="right")).astype("int32")

    sliced = rows.withColumn("_slice", slice_of("_length"))
    sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("n"), F.max("_length").alias("top")).toPandas().sort_values("_slice")
    tops, places = sizes["top"].to_numpy(), sizes["_slice"].to_numpy()
    parts = dict(zip(places.tolist(), (-(-sizes["n"] // SLICE)).tolist()))
    groups = max(1, -(-wanted // QUERIES))

    @F.pandas_udf("int")
    def reach_of(length: pd.Series, floor: pd.Series) -> pd.Series:
        """How many slices, from the longest on, may hold a row that reaches the floor."""
        least = floor.to_numpy(float)
        with np.errstate(all="ignore"):
            need = (least - 1e-6) / (length.to_numpy() * (1 + 1e-8))
        need = np.where((least <= 0) | np.isnan(need), -np.inf, need)
        return pd.Series(np.searchsorted(-tops, -need, side="right")).astype("int32")

    grouped = floors.withColumn("_group", F.pmod(F.xxhash64("_id"), F.lit(groups)).cast("int")).withColumn("_reach", reach_of("_length", "_floor"))
    reach = {g: r for g, r in grouped.groupBy("_group").agg(F.max("_reach")).collect()}
    far = spark.sparkContext.broadcast((places, parts, np.array([reach.get(g, 0) for g in range(groups)])))

    @F.pandas_udf("array<int>")
    def groups_of(slice_: pd.Series) -> pd.Series:
        places, _, reach = far.value
        return pd.Series([np.flatnonzero(reach > i).astype("int32") for i in np.searchsorted(places, slice_.to_numpy())])

    @F.pandas_udf("array<struct<_slice:int,_part:int>>")
    def parts_of(reach: pd.Series) -> pd.Series:
        places, parts, _ = far.value
        return pd.Series([[{"_slice": s, "_part": p} for s in places[:r].tolist() for p in range(parts[s])] for r in reach])

    @F.pandas_udf("int")
    def part_of(slice_: pd.Series, draw: pd.Series) -> pd.Series:
        counts = slice_.map(far.value[1])
        return (draw % counts).astype("int32")

    left = sliced.withColumn("_part", part_of("_slice", F.pmod(F.xxhash64("_id"), F.lit(1 << 40)))).select(
        "_slice", "_part", F.explode(groups_of("_slice")).alias("_group"), F.lit(False).alias("_asks"), "_id", "_x", F.lit(0).cast("long").alias("_floor"))
    right = grouped.withColumn("_place", F.explode(parts_of("_reach"))).select("_place._slice", "_place._part", "_group", F.lit(True).alias("_asks"), "_id", "_x", "_floor")
    return left.unionByName(right)


def _meet(meetings: DataFrame, turn, k: int) -> DataFrame:
    """Each part of a slice with its queries, in blocks: the best ``k`` rows of the part for each query."""
    keys = ["_slice", "_part", "_group"]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, waiting, rows = None, [], None
        for pdf in frames:
            if not len(pdf):
                continue
            held = pdf[[*keys, "_asks"]].to_numpy(np.int64)
            cut = [0, *(np.flatnonzero((held[1:] != held[:-1]).any(axis=1)) + 1).tolist(), len(pdf)]
            for a, b in zip(cut, cut[1:]):
                some, here, asks = pdf.iloc[a:b], tuple(held[a, :3]), held[a, 3]
                if here != place:
                    place, waiting, rows = here, [], None
                if not asks:
                    waiting.append(some)
                    continue
                if rows is None and waiting:
                    every = pd.concat(waiting)
                    rows, waiting = Rows(matrix(every["_x"]), every["_id"].to_numpy(), turn.value), []
                for at in range(0, len(some) if rows else 0, QUERY_BLOCK):
                    block = some.iloc[at : at + QUERY_BLOCK]
                    ids = block["_id"].to_numpy()
                    q, x, score = rows.best(matrix(block["_x"]), ids, block["_floor"].to_numpy(), k)
                    yield pd.DataFrame({"_query": ids[q], "_id": x, "_score": score})

    # Rows come before the queries that meet them.
    return meetings.repartition(*keys).sortWithinPartitions(*keys, "_asks").mapInPandas(work, "_query long, _id long, _score long")
