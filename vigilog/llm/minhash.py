"""Near-duplicate detection: fast similarity sketches, banding and exact verification."""

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.llm.components import Sets, by_group, connected, in_cells
from vigilog.llm.frame import flat, short_batches, unflat
from vigilog.storage import materialize

SHINGLE = 5
BINS = 128
BAND = 4
# Five standard deviations under the similarity asked for, as a share of equal coordinates.
LIKELY = 0.56
CELL = 512
CELL_BYTES = 8 << 20
KNOWN_WORDS = 150_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """The set of a text's shingles as sorted 64-bit hashes.

    A-Z is lower-cased and words are runs without ASCII white space. A text of fewer words
    than a shingle is one shingle; without words the set is empty.
    """

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        hashes = list(map(known.get, words))
        if None in hashes:
            if len(known) > KNOWN_WORDS:
                known.clear()
            known.update((w, xxhash.xxh3_64_intdigest(w)) for w in set(words) if w not in known)
            hashes = list(map(known.__getitem__, words))
        h = np.array(hashes, np.uint64)
        if len(h) < SHINGLE:
            return scrambled(np.array([int(np.dot(h, FACTORS[: len(h)])) + len(h)], np.uint64))
        n = len(h) - SHINGLE + 1
        s = h[:n] * FACTORS[0]
        for i in range(1, SHINGLE):
            s += h[i : i + n] * FACTORS[i]
        return np.unique(scrambled(s))


def sketch(shingles: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Fast similarity sketch of a non-empty set.

    In round i every element falls into a hashed bin with a hashed value, and a bin keeps
    its least (round, value). Rounds go on until each bin is full; from round ``bins`` on,
    round i puts all elements into bin i - ``bins``, so none stays empty. Two sets agree in
    a coordinate with the probability of their Jaccard similarity.
    """
    shift = np.uint64(64 - bins.bit_length() + 1)
    out, empty = np.zeros(bins, np.uint64), np.ones(bins, bool)
    steps = np.arange(1, 2 * bins + 1, dtype=np.uint64) * GOLDEN
    for i in range(2 * bins):
        x = scrambled(shingles + steps[i])
        salt = np.uint64(i)
        if i < bins:
            x.sort()
            at = (x >> shift).astype(np.int64)
            first = np.ones(len(x), bool)
            first[1:] = at[1:] != at[:-1]
            at, x = at[first], x[first]
            free = empty[at]
            out[at[free]] = x[free] + salt
            empty[at] = False
        elif empty[i - bins]:
            out[i - bins] = x.min() + salt
            empty[i - bins] = False
        if not empty.any():
            break
    return out


def band_keys(coordinates: np.ndarray, band: int = BAND) -> np.ndarray:
    rows = coordinates.reshape(-1, band)
    return scrambled((rows * FACTORS[:band]).sum(axis=1, dtype=np.uint64) + np.arange(1, len(rows) + 1, dtype=np.uint64) * GOLDEN).view(np.int64)


def classes_of(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The rows with their set's size and digest, sketch and band keys, written once; and the row that stands for each set."""
    short_batches(docs.sparkSession)
    shape = "_n long, _set long, _sketch binary, _keys array<long>"

    @F.pandas_udf(shape)
    def mark(texts: pd.Series) -> pd.DataFrame:
        shingles_of = Shingles()
        rows = []
        for t in texts:
            s = shingles_of(t)
            if not len(s):
                rows.append((0, 0, b"", []))
                continue
            c = sketch(s)
            digest = int(np.bitwise_xor.reduce(scrambled(s + GOLDEN)).view(np.int64))
            rows.append((len(s), digest ^ len(s), (c & np.uint64(255)).astype(np.uint8).tobytes(), band_keys(c)))
        return pd.DataFrame(rows, columns=["_n", "_set", "_sketch", "_keys"])

    at = {name.lower(): F.col(f"_c{i}") for i, name in enumerate(docs.columns)}
    marks = docs.select(*flat(docs)).select("*", mark(at[text.lower()].cast("string")).alias("_m"))
    marks = materialize(marks.select("*", "_m.*").drop("_m").withColumn("_number", F.monotonically_increasing_id()), "marks")
    # The key and the text by names of their own: the same columns, read only where asked for.
    marks = marks.withColumn("_id", at[key.lower()]).withColumn("_text", at[text.lower()].cast("string"))
    # One row stands for each set; its number is in the written table, so it names the same row in every job.
    chosen = marks.where("_n > 0").groupBy("_set").agg(F.min("_number").alias("_number"))
    return marks, chosen


def likely_pairs(marks: DataFrame, chosen: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` between sets that share a band and whose sketches are alike.

    Within a bucket only a spanning forest of the alike sets is kept, so edges are fewer than rows.
    """
    sets = marks.where("_n > 0").select("_set", "_number", "_n", "_sketch", "_keys").join(chosen.select("_number"), "_number", "left_semi")
    sets = materialize(sets.drop("_number"), "sets")
    held = sets.select("_set", F.explode("_keys").alias("_key"))
    full = held.groupBy("_key").agg(F.count(F.lit(1)).alias("_count")).where("_count > 1")
    members = held.join(full, "_key").join(sets.select("_set", "_n", "_sketch"), "_set")
    cells = in_cells(members, "_key", F.ceil(F.col("_count") / CELL), F.col("_set")).select("_key", "_i", "_j", "_set", "_n", "_sketch")

    def alike(group: pd.DataFrame) -> pd.DataFrame:
        ids, n = group["_set"].to_numpy(), group["_n"].to_numpy()
        codes = np.frombuffer(b"".join(group["_sketch"]), np.uint8).reshape(len(ids), BINS)
        left = np.arange(len(ids))
        a, b = [], []
        while len(left):
            # Breadth first from the first set left over.
            front, left = left[:1], left[1:]
            while len(front) and len(left):
                new = np.zeros(len(left), bool)
                for x in front:
                    near = (codes[left] == codes[x]).mean(axis=1) >= LIKELY
                    near &= 4 * np.minimum(n[left], n[x]) >= 3 * np.maximum(n[left], n[x])
                    near &= ~new
                    a.extend([ids[x]] * int(near.sum()))
                    b.extend(ids[left[near]])
                    new |= near
                front, left = left[new], left[~new]
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return by_group(cells, ["_key", "_i", "_j"], alike, "a long, b long").distinct()


def verified(marks: DataFrame, chosen: DataFrame, candidates: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Edges ``(a, b)`` that span the links among the sets of each candidate component ``(id, component)``.

    Links are confirmed on full sets, made again from the texts. Pairs whose sketches are
    too unlike to be links, and pairs already connected, need no test; nothing else is left out.
    """
    over, under = similarity
    asked = candidates.select(F.col("id").alias("_set"), "component").join(chosen, "_set")
    texts = asked.join(marks.select("_number", "_text", "_n", "_sketch"), "_number")
    sizes = materialize(texts.select("component", "_set", "_n", "_sketch", "_text", F.octet_length("_text").alias("_bytes")), "candidates")
    groups = sizes.groupBy("component").agg(F.count(F.lit(1)).alias("_count"), F.sum("_bytes").alias("_all"))
    parts = F.greatest(F.ceil(F.col("_count") / CELL), F.ceil(F.col("_all") / CELL_BYTES))
    cells = in_cells(sizes.join(groups, "component"), "component", parts, F.col("_set")).select("component", "_i", "_j", "_set", "_n", "_sketch", "_text")
    shingles_of: list[Shingles] = []

    def link(group: pd.DataFrame) -> pd.DataFrame:
        if not shingles_of:
            shingles_of.append(Shingles())
        ids, n = group["_set"].to_numpy(), group["_n"].to_numpy()
        codes = np.frombuffer(b"".join(group["_sketch"]), np.uint8).reshape(len(ids), BINS)
        pairs = []
        for i in range(len(ids) - 1):
            alike = (codes[i + 1 :] == codes[i]).mean(axis=1)
            near = np.flatnonzero((alike >= LIKELY) & (100 * np.minimum(n[i + 1 :], n[i]) >= over * np.maximum(n[i + 1 :], n[i]) * 100 // under))
            pairs.append(np.stack([np.full(len(near), i), near + i + 1, (alike[near] * BINS).astype(np.int64)], axis=1))
        found = np.concatenate(pairs) if pairs else np.empty((0, 3), np.int64)
        found = found[np.argsort(-found[:, 2], kind="stable")]
        texts, sets, union, a, b, tests = group["_text"].tolist(), {}, Sets(len(ids)), [], [], 0
        at = 0
        while at < len(found):
            i, j = int(found[at, 0]), int(found[at, 1])
            at += 1
            if union.find(i) == union.find(j):
                continue
            for x in (i, j):
                if x not in sets:
                    sets[x] = shingles_of[0](texts[x])
            both = len(sets[i]) + len(sets[j])
            common = both - len(np.union1d(sets[i], sets[j]))
            if under * common >= over * (both - common):
                union.join(i, j)
                a.append(ids[i])
                b.append(ids[j])
            tests += 1
            if tests % 500 == 0:
                labels = union.labels()
                rest = found[at:]
                found, at = rest[labels[rest[:, 0]] != labels[rest[:, 1]]], 0
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return by_group(cells, ["component", "_i", "_j"], link, "a long, b long")


def _linked(docs: DataFrame, key: str, text: str, similarity: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """The marked rows, and without their texts ``(_number, _id, _n, _label)``: the label is
    equal for rows that links connect and null for empty sets."""
    marks, chosen = classes_of(docs, key, text)
    chosen = materialize(chosen, "chosen")
    candidates = materialize(connected(likely_pairs(marks, chosen)), "components")
    links = materialize(verified(marks, chosen, candidates, similarity), "links")
    labels = connected(links).select(F.col("id").alias("_set"), "component")
    rows = marks.select("_number", "_id", "_n", "_set").join(labels, "_set", "left")
    label = F.when(F.col("_n") > 0, F.coalesce("component", "_set"))
    return marks, materialize(rows.select("_number", "_id", "_n", label.alias("_label")), "labels")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: tuple[int, int] = (75, 100)) -> DataFrame:
    """Adds ``n_shingles``, ``component_id`` and ``kept`` to every row.

    Rows are linked if 100 * intersection >= 75 * union of their shingle sets (a ratio of
    ``similarity``); ``component_id`` is the smallest key that links reach, ``kept`` is
    whether it is the row's own. Rows of equal sets, such as copies and repeated rows, are one
    node of the graph. Null, empty and blank texts have an empty set and link with nothing.
    A null key is never the smallest; where all keys of a component are null, so is its id, and
    its rows are kept. Texts are read whole. An empty table gives an empty result; a result
    replaces an input column of the same name.
    """
    marks, labels = _linked(docs, key, text, similarity)
    # Written, so that the join reads two plain tables and Spark can split a large component.
    least = materialize(labels.where("_label is not null").groupBy("_label").agg(F.min("_id").alias("_least")), "least")
    component = F.when(F.col("_label").isNull(), F.col("_id")).otherwise(F.col("_least"))
    found = labels.join(least, "_label", "left").select("_number", component.alias("_component"))
    joined = marks.join(found, "_number")
    return unflat(joined, docs.columns, {"n_shingles": F.col("_n"), "component_id": F.col("_component"), "kept": F.col("_id").eqNullSafe(F.col("_component"))})


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: tuple[int, int] = (75, 100)) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest key (null last), then the first written.

    Rows with an empty set all stay.
    """
    marks, labels = _linked(docs, key, text, similarity)
    order = F.struct(F.col("_id").isNull(), "_id", "_number")
    first = labels.where("_label is not null").groupBy("_label").agg(F.min(order).getField("_number").alias("_number"))
    kept = first.select("_number").unionByName(labels.where("_label is null").select("_number"))
    return unflat(marks.join(kept, "_number", "left_semi"), docs.columns, {})
