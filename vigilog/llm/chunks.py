"""Substring deduplication by content-defined chunks."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.llm.frame import col, pack, short_batches

# A cut falls behind one in CUT_WORDS words, chosen by the eight bytes before it, so chunks
# fall into step again within a few words of any insertion.
CUT_WORDS = 5
WINDOW = 8
# Where no white space came for LONG bytes, any character may be cut, one in CUT_SIGNS.
LONG, CUT_SIGNS = 64, 32
LEAST_WORDS = 24
# Rows of one key that may share a list of repeats.
ROWS_PER_SALT = 16_384

_seeded = np.random.Generator(np.random.PCG64(20_240_901))
GEAR = _seeded.integers(0, 1 << 32, 256, dtype=np.uint32)
VALUES = _seeded.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


class Powers:
    """Powers of ``BASE`` and of its inverse modulo 2^64, as far as the longest text asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 1 << 17)
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_powers = Powers()


def cuts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, words) of the chunks of a text given as UTF-8 bytes.

    The gear hash of a place sums a random number for each of the last ``WINDOW`` bytes,
    shifted by its distance; it is doubled up from one byte to the window. Chunks start
    where the text does or a word does, so a word is never torn unless it is very long.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gear = GEAR[data]
    width = 1
    while width < WINDOW:
        moved = gear[:-width] << np.uint32(width)
        gear = gear.copy()
        gear[width:] += moved
        width *= 2
    draw = gear >> np.uint32(8) & np.uint32(0xFFFF)
    space = SPACE[data]
    begins = np.empty(n, bool)  # a word begins
    begins[0] = not space[0]
    begins[1:] = space[:-1] & ~space[1:]
    cut = np.zeros(n, bool)
    cut[1:] = begins[1:] & (draw[:-1] < 65536 // CUT_WORDS)
    places = np.flatnonzero(space)
    if len(places) < n // LONG + 1 or np.diff(places, prepend=-1, append=n).max() > LONG:
        last = np.maximum.accumulate(np.where(space, np.arange(n), -1))
        cut[1:] |= (np.arange(n)[:-1] - last[:-1] >= LONG) & ((data[1:] & 0xC0) != 0x80) & (draw[:-1] < 65536 // CUT_SIGNS)
    cut[0] = True
    starts = np.flatnonzero(cut)
    return starts, np.add.reduceat(begins, starts, dtype=np.int64)


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes from each start to its end."""
    up, down = _powers(len(data))
    total = np.append(np.uint64(0), np.add.accumulate(VALUES[data] * up))
    h = (total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h.view(np.int64)


def chunked(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, digests, words) of the chunks of a text given as UTF-8 bytes."""
    starts, words = cuts(data)
    return starts, digests(data, starts, np.append(starts[1:], len(data))) if len(starts) else starts, words


def groups(data: np.ndarray, least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end, digest) of the shortest groups of neighbouring chunks that hold enough words.

    One group begins with each chunk and one ends with each, where the text has the words for
    it. So the groups inside any long enough run of chunks cover the whole run.
    """
    starts, words = cuts(data)
    m, least = len(starts), max(1, least_words)
    before = np.append(0, np.add.accumulate(words))
    end = np.searchsorted(before, before[:-1] + least)
    begin = np.searchsorted(before, before[1:] - least, side="right") - 1
    ahead, back = np.flatnonzero(end <= m), np.flatnonzero(begin >= 0)
    if not len(ahead):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = np.unique(np.concatenate([ahead * (m + 1) + end[ahead], begin[back] * (m + 1) + back + 1]))
    edges = np.append(starts, len(data))
    first, last = edges[pairs // (m + 1)], edges[pairs % (m + 1)]
    return first, last, digests(data, first, last)


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def repeated_runs(data: np.ndarray, flagged: np.ndarray, least_words: int) -> list[tuple[int, int, int]]:
    """(first byte, end, words) of each stretch that groups of flagged digests cover."""
    first, last, found = groups(data, least_words)
    hit = np.isin(found, flagged)
    if not hit.any():
        return []
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, first[hit], 1)
    np.add.at(edge, last[hit], -1)
    edges = np.flatnonzero(np.diff(np.add.accumulate(edge) > 0, prepend=False))
    starts, words = cuts(data)
    before = np.append(0, np.add.accumulate(words))
    at = np.searchsorted(starts, edges)
    return [(int(a), int(b), int(before[j] - before[i])) for a, b, i, j in zip(edges[::2], edges[1::2], at[::2], at[1::2])]


def without_runs(text: str, data: np.ndarray, runs: list[tuple[int, int, int]]) -> tuple[str, list[dict], int]:
    """The rest of the text, what was removed as (start, length) in code points, and how many words."""
    signs = np.concatenate([[0], np.add.accumulate((data & 0xC0) != 0x80, dtype=np.int64)])
    spans, kept, at = [], [], 0
    for a, b, _ in runs:
        start, end = int(signs[a]), int(signs[b])
        kept.append(text[at:start])
        spans.append({"start": start, "length": end - start})
        at = end
    kept.append(text[at:])
    return "".join(kept), spans, sum(n for *_, n in runs)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """Removes passages that a row of a smaller key also holds; adds ``removed`` and ``removed_words``.

    Texts are cut into chunks where their own bytes say so, hence alike in every text that
    shares a passage. What is compared are groups of neighbouring chunks of together at least
    ``least_words`` words: a group is a repeat if one row with a smaller key (null is the
    largest) holds the same bytes in one piece, so the first row keeps the passage. Repeats
    are taken out; shorter ones, such as single common lines, stay, and so do texts made of
    short pieces from here and there, and what a text repeats only within itself. The remains
    of a passage are the few words between its ends and the nearest cuts.

    Rows of one key count as one document and keep what they share; rows that all have null
    keys keep everything. Null texts stay null, and a text may become empty; rows are never
    dropped. An empty table gives an empty result; ``removed`` and ``removed_words`` replace
    input columns of these names.

    Rows of (digest, key) are counted and joined, never grouped, so a passage held by a
    third of all rows only means many rows of one digest, summed before the shuffle. What
    repeats is listed by key and a salt of the text, so that a null or repeated key, even
    of a third of all rows, makes many short lists.
    """
    short_batches(docs.sparkSession)
    names = [c for c in docs.columns if c.lower() not in ("removed", "removed_words")]

    @F.pandas_udf("array<long>")
    def digests_of(texts: pd.Series) -> pd.Series:
        return pd.Series([np.unique(groups(_bytes(t), least_words)[2]) for t in texts])

    salt = F.pmod(F.xxhash64(col(text).cast("string")), F.lit(1 + docs.count() // ROWS_PER_SALT)).cast("int").alias("_salt")
    held = docs.select(col(key).alias("_id"), salt, F.explode(digests_of(col(text).cast("string"))).alias("_digest"))
    owners = held.groupBy("_digest").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"), F.count(F.when(F.col("_id").isNull(), 1)).alias("_nulls"))
    shared = owners.where((F.col("_first") < F.col("_last")) | ((F.col("_nulls") > 0) & F.col("_first").isNotNull())).select("_digest", "_first")
    later = held.join(shared, "_digest").where(F.col("_id").isNull() | (F.col("_id") > F.col("_first")))
    # Equal texts share a salt and their digests; others of one key only by chance.
    lists = later.groupBy("_id", "_salt").agg(F.collect_set("_digest").alias("_repeats"))
    rows = docs.select(pack(docs), col(key).alias("_id"), salt, col(text).cast("string").alias("_text"))
    joined = rows.join(lists, rows["_id"].eqNullSafe(lists["_id"]) & (rows["_salt"] == lists["_salt"]), "left").select("_row", "_text", "_repeats")

    @F.pandas_udf("text string, removed array<struct<start:long,length:long>>, words int")
    def clean(texts: pd.Series, repeats: pd.Series) -> pd.DataFrame:
        rows = []
        for t, r in zip(texts, repeats):
            runs, data = [], None
            if t and r is not None and len(r):
                data = _bytes(t)
                runs = repeated_runs(data, np.asarray(r, np.int64), least_words)
            rows.append(without_runs(t, data, runs) if runs else (t, [], 0))
        return pd.DataFrame(rows, columns=["text", "removed", "words"]).astype({"text": object})

    cleaned = joined.select("_row", clean("_text", "_repeats").alias("_found"))
    kept = [F.col("_found.text").alias(c) if c.lower() == text.lower() else F.col("_row").getField(c).alias(c) for c in names]
    return cleaned.select(*kept, F.col("_found.removed").alias("removed"), F.col("_found.words").alias("removed_words"))
