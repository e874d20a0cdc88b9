"""Ranked lexical search: accumulator-limited scoring, a term at a time, rarest first."""

import math
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from vigilog.llm.frame import col, short_batches
from vigilog.storage import materialize

# (item, term) pairs that one pass over the documents answers, and what a task scores at a time.
PAIRS = 1_000_000
DOCS, POSTINGS = 16_384, 4_000_000
SCALE, SATURATION, LENGTH_SHARE = 1_000_000_000, 1000, 90

# Terms are runs of ASCII letters and digits and of anything beyond ASCII, which in UTF-8 is bytes from 0x80 on.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8; only A-Z are lower-cased."""
    return (text or "").encode().translate(TERM_BYTES).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def asked_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """``(_item, _term)``: the distinct terms of each item."""
    frame = items.select(col(key).alias("_item"), col(text).cast("string").alias("_text"))

    def split(batches):
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in batch.column("_text").to_pylist()]
            at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]), pa.int64())
            terms = pa.array([t.decode() for t in chain.from_iterable(found)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("_item").take(at), terms], ["_item", "_term"])

    return frame.mapInArrow(split, StructType([frame.schema["_item"], *_fields("_term string")])).distinct()


def _fields(ddl: str) -> list[StructField]:
    return list(StructType.fromDDL(ddl))


def postings(docs: DataFrame, key: str, text: str, terms: list[bytes]) -> DataFrame:
    """``(_id, _n, _terms, _tfs)`` for every document with a term: all its terms, and which of ``terms`` it holds how often."""
    frame = docs.select(col(key).alias("_id"), col(text).cast("string").alias("_text"))
    known = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})
    width = len(terms) + 1

    def count(batches):
        place = known.value.get
        for whole in batches:
            for first in range(0, whole.num_rows, 200):
                batch = whole.slice(first, 200)
                texts = [terms_of(t) for t in batch.column("_text").to_pylist()]
                n = np.array([len(t) for t in texts], np.int64)
                found = np.fromiter(map(place, chain.from_iterable(texts), repeat(-1)), np.int64, int(n.sum()))
                of = np.repeat(np.arange(len(texts)), n)[found >= 0]
                pairs, tf = np.unique(of * width + found[found >= 0], return_counts=True)
                cut = np.searchsorted(pairs, np.arange(len(texts) + 1) * width)
                term, tf = (pairs % width).astype("<i4"), tf.astype("<i4")
                held = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").take(pa.array(held, pa.int64())), pa.array(n[held], pa.int64()),
                        pa.array([term[cut[i] : cut[i + 1]].tobytes() for i in held], pa.binary()),
                        pa.array([tf[cut[i] : cut[i + 1]].tobytes() for i in held], pa.binary()),
                    ],
                    ["_id", "_n", "_terms", "_tfs"],
                )

    schema = StructType([frame.schema["_id"], StructField("_n", LongType()), StructField("_terms", BinaryType()), StructField("_tfs", BinaryType())])
    return frame.mapInArrow(count, schema)


def holding(posted: DataFrame, terms: int) -> np.ndarray:
    """How many documents hold each term: a sum for each task, added up by term."""

    def add(batches):
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column("_terms").to_pylist()), "<i4"), minlength=terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["_term", "_df"])

    sums = posted.select("_terms").mapInArrow(add, StructType([StructField("_term", IntegerType()), StructField("_df", LongType())]))
    df = np.zeros(terms, np.int64)
    for term, n in sums.groupBy("_term").agg(F.sum("_df")).collect():
        df[term] = n
    return df


def best_in_block(
    n: np.ndarray, held: np.ndarray, terms: np.ndarray, tfs: np.ndarray,
    queries: list[np.ndarray], weights: np.ndarray, documents: int, length: int, floors: list[int], k: int,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the (places, scores) of its best ``k`` documents of a block, none under its floor.

    Document i has ``n[i]`` terms and the next ``held[i]`` of the postings; equal scores go to
    the smaller place. ``queries`` are term numbers, rarest first. A term's bound is its
    weight times its greatest impact in the block; while the bounds of the terms to come
    reach the score to beat (the floor or the k-th partial score), a term opens
    accumulators, after that it only updates those which can still reach it.
    """
    order = np.argsort(terms, kind="stable")
    terms, tf, of = terms[order], tfs[order].astype(np.int64), np.repeat(np.arange(len(n)), held)[order]
    impact = SCALE * tf // (SATURATION * tf + 8 * (100 - LENGTH_SHARE + LENGTH_SHARE * n * documents // length)[of])
    starts = np.searchsorted(terms, np.arange(len(weights) + 1))
    peak, there = np.zeros(len(weights), np.int64), np.flatnonzero(starts[1:] > starts[:-1])
    if len(there):
        peak[there] = np.maximum.reduceat(impact, starts[there])
    results = []
    for query, floor in zip(queries, floors):
        query = query[peak[query] * weights[query] > 0]
        rest = np.append(np.cumsum((peak[query] * weights[query])[::-1])[::-1], 0)
        score, open_ = np.zeros(len(n), np.int64), None
        for i, term in enumerate(query.tolist()):
            if open_ is None:
                if rest[i] < score.max() and len(n) >= k:
                    floor = max(floor, int(np.partition(score, -k)[-k]))
                if rest[i] < floor:
                    open_ = (score > 0) & (score + rest[i] >= floor)
            part = slice(starts[term], starts[term + 1])
            docs, more = of[part], weights[term] * impact[part]
            if open_ is not None:
                kept = open_[docs]
                docs, more = docs[kept], more[kept]
            score[docs] += more
        found = np.flatnonzero(score >= max(floor, 1))
        if len(found) > k:
            found = found[score[found] >= np.partition(score[found], -k)[-k]]
        found = found[np.argsort(-score[found], kind="stable")[:k]]
        results.append((found, score[found]))
    return results


def ranked(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    k: int = 10, pairs: int = PAIRS,
) -> DataFrame:
    """The ``k`` best documents of ``docs`` for each item: its key, ``rank`` from 1, the document's key, ``score``.

    Scores are whole numbers: a term's weight, from the number of documents that hold it,
    times its impact, which grows with its occurrences and falls with the document's
    length; summed over the item's distinct terms. Equal scores go to the smaller key, null
    last. Documents with score 0 are not returned, so an item may have fewer rows, or none.

    Null, empty and blank texts have no terms and do not count as documents. Rows of one item
    key, null too, are one item; repeated documents are ranked each. Empty tables give an empty
    result. Only the named columns are read. Of very long texts all terms count, as long as
    90 * terms * documents fits 64 bits.

    Items are taken in blocks of about ``pairs`` (item, term) pairs by a hash of the item, and
    all documents meet each block: its terms are broadcast, documents reduced to what they
    hold of them, and every task keeps ``k`` rows an item of its documents, which set the
    score to beat for those that follow. Nothing is shuffled but these rows and sums by term.
    """
    short_batches(docs.sparkSession)
    asked = materialize(asked_terms(items, item_key, item_text), "asked")
    named = materialize(asked.select("_item").distinct().withColumn("_number", F.monotonically_increasing_id()), "items")
    numbered = asked.join(named, asked["_item"].eqNullSafe(named["_item"])).select("_number", "_term")
    blocks = max(1, -(-asked.count() // pairs))
    id_type = docs.select(col(key)).schema[0].dataType
    found = None
    for block in range(blocks):
        part = numbered.where(F.pmod(F.xxhash64("_number"), F.lit(blocks)) == block).toPandas()
        terms = sorted(t.encode() for t in part["_term"].unique())
        posted = materialize(postings(docs, key, text, terms), "postings")
        documents, length = posted.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
        best = _best(posted, id_type, part, terms, documents, length, k)
        found = best if found is None else found.unionByName(best)
    rank = F.row_number().over(Window.partitionBy("_number").orderBy(F.desc("_score"), F.asc_nulls_last("_id")))
    top = found.withColumn("_rank", rank).where(F.col("_rank") <= k)
    return top.join(named, "_number").select(F.col("_item").alias(item_key), F.col("_rank").alias("rank"), F.col("_id").alias(key), F.col("_score").alias("score"))


def _best(posted: DataFrame, id_type, part, terms: list[bytes], documents: int, length: int, k: int) -> DataFrame:
    """``(_number, _id, _score)``: each task's best documents for the items of a block."""
    df = holding(posted, len(terms))
    place = {t: i for i, t in enumerate(terms)}
    number, term = part["_number"].to_numpy(np.int64), np.array([place[t.encode()] for t in part["_term"]], np.int64)
    order = np.lexsort((term, df[term], number))
    numbers, starts = np.unique(number[order], return_index=True)
    weights = np.array([weight(documents, int(n)) for n in df], np.int64)
    spread = posted.sparkSession.sparkContext.broadcast((numbers.tolist(), np.split(term[order], starts[1:]) if len(numbers) else [], weights))

    def score(batches):
        numbers, queries, weights = spread.value
        best: list[list[tuple[int, object]]] = [[] for _ in numbers]
        waiting, rows, held = [], 0, 0

        def flush():
            ids = pa.chunked_array([b.column("_id") for b in waiting]).combine_chunks()
            order = pc.array_sort_indices(ids, null_placement="at_end")
            whole = pa.Table.from_batches(waiting).take(order)
            ids = whole.column("_id")
            blobs = whole.column("_terms").to_pylist()
            counts = np.array([len(b) // 4 for b in blobs], np.int64)
            floors = [b[-1][0] if len(b) == k else 0 for b in best]
            found = best_in_block(
                whole.column("_n").to_numpy(), counts, np.frombuffer(b"".join(blobs), "<i4"), np.frombuffer(b"".join(whole.column("_tfs").to_pylist()), "<i4"),
                queries, weights, documents, length, floors, k,
            )
            for i, (places, scores) in enumerate(found):
                if len(places):
                    more = zip(scores.tolist(), ids.take(pa.array(places)).to_pylist())
                    best[i] = sorted([*best[i], *more], key=lambda x: (-x[0], x[1] is None, x[1]))[:k]

        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                batch = whole.slice(first, 1000)
                waiting.append(batch)
                rows += batch.num_rows
                held += batch.column("_terms").nbytes // 4
                if rows >= DOCS or held >= POSTINGS:
                    flush()
                    waiting, rows, held = [], 0, 0
        if waiting:
            flush()
        out = [(n, i, s) for n, b in zip(numbers, best) for s, i in b]
        columns = [pa.array([x[j] for x in out], t) for j, t in ((0, pa.int64()), (1, _arrow(id_type)), (2, pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["_number", "_id", "_score"])

    schema = StructType([StructField("_number", LongType()), StructField("_id", id_type), StructField("_score", LongType())])
    return posted.mapInArrow(score, schema)


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
