"""Spelling variants: words one letter apart, by a dictionary of pairs of trie nodes."""

import os
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilog.llm.frame import col, short_batches
from vigilog.storage import materialize

LEAST_LETTERS, LEAST_COUNT, TIMES = 6, 5, 5
TYPO_RATE = 199
# Words numbered in one task, and the bits of a node's number: part, word, depth.
PART = 50_000
PART_BITS, WORD_BITS, DEPTH_BITS = 19, 20, 24
# Different words that a task counts before it hands the sums on.
COUNTED = 200_000

# Runs are letters from A to Z and from U+00C0 to U+00FF; both are single bytes in Latin-1.
RUN_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs_of(text: str | None) -> list[bytes]:
    """The letter runs of a text as Latin-1, A-Z lower-cased."""
    return (text or "").encode("latin-1", "replace").translate(RUN_BYTES).split()


def word_of(run: bytes, key: bytes) -> bytes:
    """A run as the document of this key has it: one letter short where the checksum says so."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), zlib.crc32(key))
    if h % TYPO_RATE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)``: how often each long enough word occurs in all texts. Tasks add up before the shuffle."""
    short_batches(docs.sparkSession)
    frame = docs.select(F.coalesce(col(key).cast("string"), F.lit("")).alias("_key"), col(text).cast("string").alias("_text"))

    def count(batches):
        total: Counter[bytes] = Counter()
        for batch in batches:
            for key, text in zip(batch.column("_key").to_pylist(), batch.column("_text").to_pylist()):
                before = f"{key}:".encode()
                for run, n in Counter(runs_of(text)).items():
                    if len(run) >= least_letters:
                        total[word_of(run, before)] += n
            if len(total) > COUNTED:
                yield summed(total)
                total.clear()
        yield summed(total)

    def summed(total: Counter) -> pa.RecordBatch:
        long_enough = [(w.decode("latin-1"), n) for w, n in total.items() if len(w) >= least_letters]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in long_enough], pa.string()), pa.array([n for _, n in long_enough], pa.int64())], ["word", "n"])

    return frame.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def shared(a: str, b: str) -> int:
    return len(os.path.commonprefix([a, b]))


def border_nodes(edges: list[tuple[str, str]]) -> list[tuple[str, list[int]]]:
    """For the border behind each sorted part but the last: the prefix that the words on both sides share, and the numbers of its nodes.

    A node that lies on several borders is numbered by the first of them and its depth, below zero.
    """
    borders: list[tuple[str, list[int]]] = []
    for q, ((_, last), (first, _)) in enumerate(zip(edges, edges[1:])):
        prefix = last[: shared(last, first)]
        same = shared(borders[-1][0], prefix) + 1 if borders else 0
        inherited = borders[-1][1][:same] if borders else []
        borders.append((prefix, inherited + [-1 - ((q << DEPTH_BITS) | i) for i in range(same, len(prefix) + 1)]))
    return borders


def part_nodes(paths: list[str], part: int, before: tuple[str, list[int]] | None, after: tuple[str, list[int]] | None) -> list[np.ndarray]:
    """The trie nodes from the root to the end of each of a part's sorted paths.

    A node is numbered by the part's first path through it and its depth; those on a border
    of the part have the border's numbers, so all parts agree.
    """
    if part >= 1 << PART_BITS or len(paths) > 1 << WORD_BITS or any(len(p) >= 1 << DEPTH_BITS for p in paths):
        raise ValueError("too many parts, paths or letters for the bits of a node's number")
    last, nodes = before if before else ("", [])
    out = []
    for rank, path in enumerate(paths):
        known = min(len(nodes), shared(last, path) + 1)
        base = ((part << WORD_BITS) | rank) << DEPTH_BITS
        nodes = nodes[:known] + [base | i for i in range(known, len(path) + 1)]
        if after:
            onto = shared(path, after[0]) + 1
            nodes[:onto] = after[1][:onto]
        out.append(np.array(nodes, np.int64))
        last = path
    return out


def trie_nodes(words: DataFrame, backward: bool) -> DataFrame:
    """``(word, n, number, nodes)``, with ``nodes[i]`` the number of the node that the first i letters reach.

    With ``backward`` the trie holds the words from their ends. Numbers rise in code-point
    order of the path. Parts are ranges of the sorted paths of about ``PART`` words; of each
    only its least and greatest path reach the driver.
    """
    path = F.reverse("word") if backward else F.col("word")
    parts = max(1, -(-words.count() // PART))
    ranged = words.withColumn("_path", path).repartitionByRange(parts, "_path").withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged, "paths")
    edges = sorted(ranged.groupBy("_part").agg(F.min("_path"), F.max("_path")).collect())
    borders = border_nodes([(a, b) for _, a, b in edges])
    places = {p: i for i, (p, *_) in enumerate(edges)}
    spread = words.sparkSession.sparkContext.broadcast((places, borders))

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        places, borders = spread.value
        pdf = pdf.sort_values("_path", ignore_index=True)
        part = places[int(pdf["_part"].iloc[0])]
        before, after = borders[part - 1] if part else None, borders[part] if part < len(borders) else None
        nodes = part_nodes(pdf["_path"].tolist(), part, before, after)
        return pd.DataFrame({"word": pdf["word"], "n": pdf["n"], "number": (part << WORD_BITS) + np.arange(len(pdf)), "nodes": nodes})

    return ranged.groupBy("_part").applyInPandas(number, "word string, n long, number long, nodes array<long>")


def placed_words(words: DataFrame) -> DataFrame:
    """``(number, word, n, heads, tails)``: a word's nodes in the trie of all words and in that of the words read backward."""
    heads = trie_nodes(words, False).withColumnRenamed("nodes", "heads")
    tails = trie_nodes(words, True).select("word", F.col("nodes").alias("tails"))
    return heads.join(tails, "word").select("number", "word", "n", "heads", "tails")


def node_pairs(placed: DataFrame) -> DataFrame:
    """The dictionary: ``(head, tail, kind, number, n)``.

    Kind 0 is a word itself, split anywhere: the node of what stands before and that of
    what comes after. Kinds 1 and 2 skip one letter; of a run of equal letters, which all
    leave the same rest, the first has kind 2.
    """
    both = placed.withColumn("_last", F.size("heads") - 1).withColumn("_letters", F.split("word", ""))
    letter = lambda i: F.get("_letters", i)
    pair = lambda i, skip, kind: F.struct(F.get("heads", i).alias("head"), F.get("tails", F.col("_last") - skip - i).alias("tail"), kind.cast("byte").alias("kind"))
    first = lambda i: F.when((i > 0) & (letter(i) == letter(i - 1)), 1).otherwise(2)
    split = F.transform(F.sequence(F.lit(0), F.col("_last")), lambda i: pair(i, 0, F.lit(0)))
    skipped = F.transform(F.sequence(F.lit(0), F.col("_last") - 1), lambda i: pair(i, 1, first(i)))
    return both.select("number", "n", F.explode(F.concat(split, skipped)).alias("_pair")).select("_pair.head", "_pair.tail", "_pair.kind", "number", "n")


def neighbours(pairs: DataFrame) -> DataFrame:
    """``(number, n_near, best)``: how many near words a word has, and the (n, number) of the one that occurs most.

    Rows of one (head, tail) are near: words with one letter skipped there differ by that
    letter, and skipping leaves the word that is split there. They are at most two for each
    letter of the alphabet and one, so their window is small whatever the corpus.
    """
    order = [F.desc("n"), "number"]
    here = Window.partitionBy("head", "tail").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    me = F.struct((-F.col("n")).alias("n"), "number")
    kind = F.col("kind")
    of = lambda kinds: F.when(kinds, me)
    skips, firsts, splits = kind > 0, kind == 2, kind == 0
    seen = pairs.select(
        "number", "n", "kind",
        F.count(of(skips)).over(here).alias("skips"), F.count(of(firsts)).over(here).alias("firsts"), F.count(of(splits)).over(here).alias("splits"),
        F.nth_value(of(skips), 1, True).over(here).alias("skip_1"), F.nth_value(of(skips), 2, True).over(here).alias("skip_2"),
        F.nth_value(of(firsts), 1, True).over(here).alias("first_1"), F.nth_value(of(splits), 1, True).over(here).alias("split_1"),
    )
    other = F.when(F.col("skip_1.number") == F.col("number"), F.col("skip_2")).otherwise(F.col("skip_1"))
    near = F.when(splits, F.col("firsts")).when(firsts, F.col("skips") - 1 + F.col("splits")).otherwise(F.col("skips") - 1)
    best = F.when(splits, F.col("first_1")).when(firsts, F.least(other, F.col("split_1"))).otherwise(other)
    some = seen.select("number", near.alias("near"), best.alias("best")).where("near > 0")
    return some.groupBy("number").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``(number, root)`` for each ``(number, form)``: where following forms ends.

    Each round joins the table with itself and doubles the steps taken; forms grow by a
    factor, so chains are short and a few rounds do.
    """
    links = materialize(forms.select("number", F.col("form").alias("root")), "roots")
    while True:
        ahead = links.select(F.col("number").alias("root"), F.col("root").alias("_next"))
        step = materialize(links.join(ahead, "root", "left").select("number", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        links = step.select("number", "root")
        if not step.where("_moved").head(1):
            return links


def variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, times: int = TIMES,
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for each word of all texts.

    Words are letter runs, A-Z lower-cased, of at least ``least_letters`` letters and ``least_count``
    occurrences. Two are near if one inserted, deleted or replaced letter tells them apart.
    A word's form is its near word that occurs most, ties to the smallest in code-point
    order, if it occurs at least ``times`` as often as the word; ``root`` is where forms lead.

    Null and empty texts have no words; a null key counts as an empty one; every row is read
    whole, repeated rows too. Words of any length are taken. No words, as in an empty table,
    give an empty result. Only the two named columns are read.
    """
    words = materialize(word_counts(docs, key, text, least_letters, least_count), "words")
    placed = materialize(placed_words(words), "placed")
    near = neighbours(node_pairs(placed))
    counted = placed.select("number", "word", "n").join(near, "number", "left")
    is_form = -F.col("best.n") >= times * F.col("n")
    formed = materialize(counted.select(
        "number", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.number")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n"),
    ), "forms")
    led = formed.join(roots(formed.where("form is not null")), "number", "left")
    names = placed.select("number", "word")
    named = led.join(names.toDF("form", "_form"), "form", "left").join(names.toDF("root", "_root"), "root", "left")
    return named.select("word", "n", "n_near", F.col("_form").alias("form"), "form_n", F.coalesce("_root", "word").alias("root"))
