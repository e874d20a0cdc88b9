"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations."""

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.llm.components import Sets, by_small_group, connected, in_cells
from vigilog.llm.frame import col, pack, unpack
from vigilog.llm.vectors import doubles, packed, usable
from vigilog.storage import materialize

# 14 tables of three hashes, three probes on either side: a pair at cosine 0.95 in 64
# dimensions is missed less than once in 10^5 times.
TABLES, HASHES, PROBES = 14, 3, 3
CELL = 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    rows, n = x.shape
    width = 1
    while width < n:
        x = x.reshape(rows, n // (2 * width), 2, width)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(rows, n)
        width *= 2
    return x / math.sqrt(n)


@lru_cache(maxsize=64)
def _signs(size: int, number: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([size, number])).choice([-1.0, 1.0], (3, size))


def bucket_keys(x: np.ndarray) -> np.ndarray:
    """(rows, TABLES, PROBES) keys of unit vectors.

    A hash is the axis, with its sign, nearest to the vector after three rounds of random
    signs and Hadamard transform. A table's own bucket takes the nearest axis of each hash;
    the further probes take the second nearest of one hash, where the least is lost by it.
    """
    rows, dims = x.shape
    size = max(2, 1 << (dims - 1).bit_length())
    padded = np.zeros((rows, size))
    padded[:, :dims] = x
    keys = np.empty((rows, TABLES, PROBES), np.int64)
    every = np.arange(rows)
    for t in range(TABLES):
        own = np.full(rows, dims * TABLES + t, np.uint64)
        losses, changes = np.empty((rows, HASHES)), np.empty((rows, HASHES), np.uint64)
        for j in range(HASHES):
            y = padded
            for signs in _signs(size, t * HASHES + j):
                y = hadamard(y * signs)
            far = np.abs(y)
            first = far.argmax(axis=1)
            top = far[every, first]
            far[every, first] = -1.0
            second = far.argmax(axis=1)
            losses[:, j] = top - far[every, second]
            code = lambda at: (2 * at + (y[every, at] < 0)).astype(np.uint64)  # noqa: E731, B023
            weight = np.uint64(pow(0x9E3779B97F4A7C15, j + 1, 1 << 64))
            own = own + code(first) * weight
            changes[:, j] = (code(second) - code(first)) * weight
        order = losses.argsort(axis=1)[:, : PROBES - 1]
        found = np.concatenate([own[:, None], own[:, None] + np.take_along_axis(changes, order, 1)], axis=1)
        found = (found ^ (found >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        keys[:, t] = (found ^ (found >> np.uint64(29))).view(np.int64)
    return keys


def _hashed(docs: DataFrame, key: str, vector: str) -> DataFrame:
    """Distinct usable directions' bytes as ``_x``, with their keys; other rows have null ``_x``."""
    def mark(frames):
        for pdf in frames:
            blobs, keys, codes = ([None] * len(pdf) for _ in range(3))
            by_size: dict[int, list[int]] = {}
            values = pdf["_v"].tolist()
            for i, v in enumerate(values):
                if v is not None and len(v):
                    by_size.setdefault(len(v), []).append(i)
            for at in by_size.values():
                x = np.array([values[i] for i in at], float)
                # Scaled first, so that squares neither vanish nor overflow.
                scale = np.abs(x).max(axis=1)
                at, x, scale = [i for i, s in zip(at, scale) if s > 0], x[scale > 0], scale[scale > 0]
                if not at:
                    continue
                unit = x / scale[:, None]
                unit /= np.sqrt((unit * unit).sum(axis=1))[:, None]
                for i, row, k in zip(at, x, bucket_keys(unit)):
                    blobs[i], keys[i], codes[i] = packed(row), k.reshape(-1).tolist(), k.tobytes()
            yield pd.DataFrame({"_number": pdf["_number"], "_x": pd.Series(blobs, pdf.index, object), "_keys": pd.Series(keys, pdf.index, object), "_codes": pd.Series(codes, pdf.index, object)})

    ids = materialize(
        docs.select(pack(docs), col(key).alias("_id"), F.when(usable(col(vector)), doubles(docs, vector)).alias("_v")).withColumn("_number", F.monotonically_increasing_id()),
        "vectors",
    )
    found = ids.select("_number", "_v").mapInPandas(mark, "_number long, _x binary, _keys array<long>, _codes binary")
    return ids.drop("_v"), materialize(found, "hashed")


def linked(ids: np.ndarray, x: np.ndarray, keys: np.ndarray, copies: np.ndarray, bucket: int, cell: np.ndarray, inner: list[int], cosine: float):
    """Links within one bucket that no earlier bucket of both ends has: (spanning pairs, links of each row).

    Pairs of different cells are looked at, and pairs within the cells of ``inner``. A pair
    counts, and may join two trees, only where it first meets: in no earlier table, and in
    the least common bucket of this one.
    """
    n = len(ids)
    unit = x / np.abs(x).max(axis=1)[:, None]
    unit = unit / np.sqrt((unit * unit).sum(axis=1))[:, None]
    near = unit @ unit.T
    counts = np.zeros(n, np.int64)
    a, b = np.nonzero(np.triu(near >= cosine - 1e-12, 1))
    if len(inner) < len(np.unique(cell)):
        own = (cell[a] != cell[b]) | np.isin(cell[a], inner)
        a, b = a[own], b[own]
    if not len(a):
        return [], counts
    # So near to the bound, sums are taken exactly.
    close = np.flatnonzero(np.abs(near[a, b] - cosine) < 1e-12)
    if len(close):
        under = [i for i in close if math.fsum(unit[a[i]] * unit[b[i]]) < cosine]
        a, b = np.delete(a, under), np.delete(b, under)
    table = int(np.flatnonzero((keys == bucket).any(axis=(0, 2)))[0])
    for first in range(0, len(a), 1 << 14):
        i, j = a[first : first + (1 << 14)], b[first : first + (1 << 14)]
        for t in range(table):
            met = np.zeros(len(i), bool)
            for p in range(PROBES):
                for q in range(PROBES):
                    met |= keys[i, t, p] == keys[j, t, q]
            i, j = i[~met], j[~met]
            if not len(i):
                break
        if len(i):
            same = keys[i, table][:, :, None] == keys[j, table][:, None, :]
            least = np.where(same, keys[i, table][:, :, None], np.iinfo(np.int64).max).min(axis=(1, 2))
            i, j = i[least == bucket], j[least == bucket]
        np.add.at(counts, i, copies[j])
        np.add.at(counts, j, copies[i])
        kept = (i, j) if not first else (np.concatenate([kept[0], i]), np.concatenate([kept[1], j]))
    union = Sets(n)
    pairs = [(ids[i], ids[j]) for i, j in zip(kept[0].tolist(), kept[1].tolist()) if union.join(i, j)]
    return pairs, counts


def near_vectors(docs: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.95) -> DataFrame:
    """Adds ``n_links``, ``component_id`` and ``kept`` to every row.

    Rows whose vectors have a cosine of at least ``cosine`` in double precision are linked;
    pairs are looked for in shared buckets and each is verified. ``n_links`` counts the other
    rows linked directly, ``component_id`` is the smallest key reached, ``kept`` whether it is
    the row's own. Vectors that are null, empty, zero or hold null or non-finite components,
    and vectors of different length, link with nothing. Equal vectors are one node that counts
    as often as it occurs, so copies are never paired; repeated rows are copies too. Null keys
    are never the smallest. An empty table gives an empty result; a result replaces an input
    column of the same name.

    A bucket is split in cells of ``CELL`` nodes, each pair of which is one group of work.
    """
    ids, hashed = _hashed(docs, key, vector)
    valid = hashed.where("_x is not null")
    nodes = materialize(valid.groupBy("_x").agg(F.min("_number").alias("_node"), F.count(F.lit(1)).alias("_copies"), F.first("_keys").alias("_keys"), F.first("_codes").alias("_codes")), "nodes")
    held = nodes.select("_node", F.explode("_keys").alias("_bucket"))
    full = held.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_count")).where("_count > 1")
    cells = in_cells(held.join(full, "_bucket"), "_bucket", F.ceil(F.col("_count") / CELL), F.col("_node"))
    parts = F.ceil(F.col("_count") / CELL).cast("int")
    rows = cells.withColumn("_cell", F.pmod(F.xxhash64("_node"), parts).cast("int")).select("_bucket", "_i", "_j", "_cell", "_node")
    rows = rows.join(nodes.select("_node", "_x", "_codes", "_copies"), "_node")

    def work(group: dict[str, np.ndarray]):
        i, j, node = int(group["_i"][0]), int(group["_j"][0]), group["_node"]
        x = np.frombuffer(b"".join(group["_x"]), "<f8").reshape(len(node), -1)
        keys = np.frombuffer(b"".join(group["_codes"]), np.int64).reshape(len(node), TABLES, PROBES)
        # Pairs within cell 0 belong to the first pair of cells that holds it, those within cell c to (0, c).
        inner = [c for c in {i, j} if i == j or i == 0 and (c == j or j == 1)]
        pairs, counts = linked(node, x, keys, group["_copies"], int(group["_bucket"][0]), group["_cell"], inner, cosine)
        some = np.flatnonzero(counts)
        if not pairs and not len(some):
            return None
        ends = np.array(pairs, np.int64).reshape(-1, 2)
        none = np.full(len(some), -1)
        return np.concatenate([ends[:, 0], node[some]]), np.concatenate([ends[:, 1], none]), np.concatenate([np.zeros(len(ends), np.int64), counts[some]])

    found = materialize(by_small_group(rows, ["_bucket", "_i", "_j"], work, "a long, b long, links long", ["a", "b", "links"]), "links")
    links = found.where("b = -1").groupBy("a").agg(F.sum("links").alias("_links"))
    components = connected(found.where("b >= 0").select("a", "b"))
    labelled = (
        valid.select("_number", "_x").join(nodes.select("_x", "_node", "_copies"), "_x")
        .join(links.withColumnRenamed("a", "_node"), "_node", "left").join(components.withColumnRenamed("id", "_node"), "_node", "left")
        .select("_number", (F.coalesce("_links", F.lit(0)) + F.col("_copies") - 1).alias("_n"), F.coalesce("component", "_node").alias("_label"))
    )
    rows = materialize(ids.join(labelled, "_number", "left"), "labelled")
    least = rows.where("_label is not null").groupBy("_label").agg(F.min("_id").alias("_least"))
    joined = rows.join(least, "_label", "left")
    component = F.when(F.col("_label").isNull(), F.col("_id")).otherwise(F.col("_least"))
    return unpack(joined, docs.columns, {"n_links": F.coalesce("_n", F.lit(0)), "component_id": component, "kept": F.col("_id").eqNullSafe(component)})
