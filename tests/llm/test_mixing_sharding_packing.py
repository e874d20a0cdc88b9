import math
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import untouched
from vigilog.llm import mixing, packing, sharding
from vigilog.llm.frame import salts, with_positions, word_count
from vigilog.llm.queries import word_tokenizer


def test_positions_are_gapless_and_sums_run(spark):
    rows = [(k, c, v) for k in "ab" for c in (3, 1, 2) for v in range(5)]
    df = spark.createDataFrame(rows, "k string, cell long, v long")
    got = with_positions(df, ["k"], "cell", [F.col("v")], {"_before": F.col("v")}, {"_first": F.col("v") + F.col("cell")}).collect()
    for k in "ab":
        own = sorted((r for r in got if r.k == k), key=lambda r: r._index)
        assert [(r.cell, r.v) for r in own] == [(c, v) for c in (1, 2, 3) for v in range(5)]
        assert [r._index for r in own] == list(range(15))
        assert [r._before for r in own] == [sum(x.v for x in own[:i]) for i in range(15)]
        assert {r._first for r in own} == {1}
    assert salts(0) == 16 and salts(1 << 40) > 1 << 17


def shares(sizes, weights, most):
    """Repeated resharing until no target is above its stop."""
    total, target, full = sum(sizes.values()), {}, set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_ = [s for s in sizes if s not in full]
        target = {s: most * sizes[s] if s in full else left * weights[s] / sum(weights[x] for x in open_) for s in sizes}
        over = {s for s in open_ if target[s] > most * sizes[s]}
        if not over or not open_:
            return target
        full |= over


def test_mix(odd, odd_rows):
    mixed = mixing.mix(odd, word_count(F.col("text")))
    untouched(mixed, {"size", "copies"})
    got = mixed.collect()
    assert len(got) == len(odd_rows)
    sizes = defaultdict(int)
    for _, text, _, source in odd_rows:
        sizes[source] += len((text or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    target = shares(dict(sizes), {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3.0)
    largest = defaultdict(int)
    taken = Counter()
    for r in got:
        assert r.size == len((r.text or "").split()) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source], abs=1e-6) and 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= 2 * largest[s] + 1 for s in sizes)
    again = mixing.mix(odd.repartition(7), word_count(F.col("text"))).collect()
    key = lambda rows: Counter((r.doc_id, r.text, r.copies) for r in rows)
    assert key(got) == key(again)
    out = mixing.repeated(mixed, odd.columns)
    assert out.columns == odd.columns and out.count() == sum(r.copies for r in got)


def test_mix_of_nothing(empty):
    assert mixing.mix(empty, word_count(F.col("text"))).collect() == []


def test_mix_near_target_over_many_rows(spark):
    docs = spark.range(6000).select("id", F.concat(F.lit("s"), F.col("id") % 4).alias("source"), (F.xxhash64("id") % 97 + 100).alias("w"))
    rows = mixing.mix(docs, F.col("w")).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("t"), F.first("target").alias("g")).collect()
    assert all(abs(r.t / r.g - 1) < 0.01 for r in rows)


def slow_best_fit(sizes, capacity):
    rooms, out = [], []
    for s in sizes:
        fits = [(r, i) for i, r in enumerate(rooms) if r >= s and r > 0]
        i = min(fits)[1] if fits else len(rooms)
        if not fits:
            rooms.append(capacity)
        rooms[i] = max(0, rooms[i] - s)
        out.append(i)
    return out


def test_best_fit_is_best_fit():
    rng = np.random.default_rng(3)
    for capacity in (10, 100, 1000):
        sizes = sorted(rng.integers(1, capacity + 2, 300).tolist(), reverse=True)
        assert sharding.best_fit(sizes, capacity) == slow_best_fit(sizes, capacity)


def test_balanced_gives_giants_their_own():
    sizes = [1000, 900, *[10] * 60, *[1] * 40]
    bins = sharding.balanced(sizes, 8)
    load = Counter()
    for s, b in zip(sizes, bins):
        load[b] += s
    rest = sorted(load.values())[:6]
    assert max(bins) == 7 and bins.count(0) == 1 and bins.count(1) == 1 and rest[-1] - rest[0] <= 10
    assert sharding.balanced([], 8) == [] and max(sharding.balanced([0] * 9, 4)) <= 3


def test_even_shards(odd, odd_rows, empty):
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    done = sharding.even_shards(odd, F.col("text"), size, 4)
    untouched(done, {"shard", "slot"})
    got = done.collect()
    assert len(got) == len(odd_rows)
    where = defaultdict(set)
    for r in got:
        where[r.text].add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    for shard in range(4):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert sharding.even_shards(empty, F.col("text"), size, 4).collect() == []


def test_fixed_shards(spark):
    docs = spark.range(3000).select("id", F.concat(F.lit("g"), F.col("id") % 700).alias("g"), (F.col("id") % 13 + 1).alias("w"))
    got = sharding.fixed_shards(docs, F.col("g"), F.col("w"), 500, per_cell=4).collect()
    load, where = Counter(), defaultdict(set)
    for r in got:
        load[r.shard] += r.w
        where[r.g].add(r.shard)
    assert len(got) == 3000 and max(load.values()) <= 500 and all(len(s) == 1 for s in where.values())
    assert len(load) <= 1.25 * math.ceil(sum(load.values()) / 500)


def slow_sum_of_squares(sizes, capacity):
    """The definition: try every level and recompute the sum."""
    counts, out = Counter(), []
    for s in sizes:
        best = None
        for level in range(capacity - s, -1, -1):
            if level and not counts[level]:
                continue
            after = Counter(counts)
            if level:
                after[level] -= 1
            if level + s < capacity:
                after[level + s] += 1
            total = sum(v * v for v in after.values())
            if best is None or total < best[0]:
                best = (total, level, after)
        out.append(best[1])
        counts = best[2]
    return out


def test_sum_of_squares_is_its_definition():
    rng = np.random.default_rng(8)
    for capacity in (7, 16, 40):
        sizes = rng.integers(1, capacity + 1, 200)
        bins, offsets = packing.sum_of_squares(sizes, capacity)
        assert offsets.tolist() == slow_sum_of_squares(sizes.tolist(), capacity)
        fill = Counter()
        for s, b, o in zip(sizes, bins, offsets):
            assert fill[b] == o
            fill[b] += s
        assert max(fill.values()) <= capacity


def test_pieces_are_the_tokenizer_s(odd, odd_rows, empty):
    from tokenizers import Tokenizer

    path = word_tokenizer()
    tokenizer = Tokenizer.from_file(path)
    done = packing.packed_documents(odd, path)
    untouched(done, {"start", "length", "offset"})
    got = done.collect()
    assert "text" not in done.columns
    parts = defaultdict(list)
    for r in got:
        parts[r.doc_id].append(r)
    want = Counter()
    for key, text, *_ in odd_rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        for start in range(0, len(ids), 4096):
            want[(key, start, np.array(ids[start : start + 4096], "<u4").tobytes(), len(ids))] += 1
    assert Counter((r.doc_id, r.start, bytes(r.ids), r.doc_tokens) for r in got) == want
    lines = defaultdict(list)
    for r in got:
        lines[r.sequence_id].append((r.offset, r.length))
    for line in lines.values():
        at = 0
        for offset, n in sorted(line):
            assert offset == at
            at += n
        assert at <= 4096
    whole = packing.sequences(done).collect()
    for r in whole:
        n = len(r.ids) // 4
        assert n == 4096 or n == r.tokens and n & (n - 1) == 0
    assert sum(r.tokens for r in whole) == sum(r.length for r in got)
    assert packing.packed_documents(empty, path).collect() == []


def test_words_encoded_alone_equal_texts_encoded_whole():
    from tokenizers import Tokenizer

    path = word_tokenizer()
    tokenizer = Tokenizer.from_file(path)
    texts = [
        "It's 's''s don't ½²³ x\x85y\xa0z ÀÉ İΣ aΣ. <|endoftext|> 12a3", "'S 'LL'd ªµº \x1c a\x1fb", "", " ", "ab'cd ef's. x_y_z a__ b-- c--d É. ß? µ. é´ a´b",
        "a <|startoftext|> b", "<|endoftext|>", "A<|STARTOFTEXT|>b", "á b", "x\ty\x0bz\x0c", "wait... no,,, a.b.c (x) [y]; z!?", "naïve façade — “quoted” 漢字",
    ]
    ids = packing.Ids(path)
    for _ in range(2):
        for text, found in zip(texts, ids(texts)):
            assert found == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_query_digests(spark):
    from vigilog.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    shards = QUERIES["op8_shards"](spark, sf).collect()
    assert {r.doc_id for r in shards} == set(docs) and all(r.text_crc32 == zlib.crc32(docs[r.doc_id].encode()) for r in shards)
    load = Counter()
    for r in shards:
        load[r.shard] += r.size
        assert r.size == len(docs[r.doc_id].encode()) + 1
    assert max(load.values()) - min(load.values()) <= 0.2 * max(load.values())
    packed = QUERIES["op6_packing"](spark, sf).collect()
    assert sum(r.length for r in packed) == sum({r.doc_id: r.doc_tokens for r in packed}.values())
    fill = len({r.sequence_id for r in packed}) * 4096
    assert sum(r.length for r in packed) > 0.8 * fill
    assert os.path.exists(word_tokenizer())
