import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import untouched, words
from vigilog.llm import bestfit, lexical, variants
from vigilog.llm.queries import byte_tokenizer

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def slow_ranking(docs, items, k=10):
    """Every document scored for every item, as the contract words it."""
    held = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, length = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(TERM.findall((text or "").translate(LOWER)))
    out = []
    for item, terms in asked.items():
        scores = []
        for i, c, n in held:
            m = 100 - 90 + 90 * n * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("block", [(lexical.DOCS, lexical.PAIRS), (7, 30)])
def test_ranking_is_that_of_all_scores(spark, odd, odd_rows, empty, monkeypatch, block):
    """In one block, and with blocks of few documents and items, where floors are handed on."""
    monkeypatch.setattr(lexical, "DOCS", block[0])
    rng = random.Random(3)
    texts = [r[1] for r in odd_rows if r[1]]
    items = [(i, " ".join(rng.choices(rng.choice(texts).split() or ["x"], k=12)).upper()) for i in range(25)]
    items += [(30, None), (31, "  "), (32, "zzzzzzzz nowhere"), (None, "one two"), (33, "ONE"), (33, "two two")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("own")).withColumn("doc_id", F.lit("own"))
    got = lexical.ranked(odd, asked, pairs=block[1])
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == slow_ranking([r[:2] for r in odd_rows], items)
    assert lexical.ranked(empty, asked).collect() == [] and lexical.ranked(odd, asked.limit(0)).collect() == []


def test_no_accumulators_are_opened_once_the_rest_is_too_small():
    """A block with floors above what its common term gives returns nothing for it, and exact sums for survivors."""
    rng = np.random.default_rng(4)
    n_docs, terms, k = 400, 30, 5
    weights = np.sort(rng.integers(1, 3000, terms))[::-1].copy()
    rows = [np.sort(rng.choice(terms, rng.integers(1, 12), replace=False)) for _ in range(n_docs)]
    tfs = [rng.integers(1, 6, len(r)) for r in rows]
    n = np.array([int(t.sum()) + 3 for t in tfs])
    length = int(n.sum())
    m = 10 + 90 * n * n_docs // length
    queries = [np.sort(rng.choice(terms, 9, replace=False)) for _ in range(20)]
    want = []
    for q in queries:
        scores = [sum(int(weights[t]) * (10**9 * int(f) // (1000 * int(f) + 8 * int(m[i]))) for t, f in zip(rows[i], tfs[i]) if t in q) for i in range(n_docs)]
        want.append(sorted((-s, i) for i, s in enumerate(scores) if s > 0)[:k])
    held = np.array([len(r) for r in rows])
    block = n, held, np.concatenate(rows).astype("<i4"), np.concatenate(tfs).astype("<i4"), queries, weights, n_docs, length
    for floors in ([0] * 20, [-w[2][0] for w in want], [-w[0][0] + 1 for w in want]):
        for (places, scores), w, floor in zip(lexical.best_in_block(*block, floors, k), want, floors):
            assert list(zip((-scores).tolist(), places.tolist())) == [x for x in w if -x[0] >= floor]


def slow_variants(docs, least=5):
    n = Counter()
    for key, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= least}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    found = {w: [v for v in n if v != w and near(v, w)] for w in n}
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, n[w], len(found[w]), form[w], n[form[w]] if form[w] else None, root))
    return out


@pytest.fixture(scope="module")
def spelled():
    """Words of few letters, so that many are near: some of them frequent, with a chain of forms."""
    rng = random.Random(9)
    docs = []
    for i in range(260):
        some = ["".join(rng.choices("abé", k=rng.randint(6, 7))) for _ in range(40)]
        docs.append((i, " ".join(some)))
    chain = ["banana"] * 250 + ["bananas"] * 40 + ["bananass"] * 6 + ["Ünlücky×"] * 5 + ["x" * 3000] * 5 + ["x" * 2999] * 30
    docs += [(1000 + i, f"{w}, {w.upper()}") for i, w in enumerate(chain)]
    return docs + [(None, "no key here " * 6), (None, None), (2000, ""), (2000, "\x00\t"), (2001, "日本語 façade— façadé " * 9), (2001, "日本語 façade— façadé " * 9)]


@pytest.mark.parametrize("part", [variants.PART, 23])
def test_variants_are_those_of_all_pairs(spark, spelled, monkeypatch, part):
    """In one part, and in many parts whose borders share trie nodes."""
    monkeypatch.setattr(variants, "PART", part)
    docs = spark.createDataFrame(spelled, "doc_id long, text string").withColumn("word", F.lit("own")).withColumn("n", F.lit("own")).repartition(5)
    got = variants.variants(docs).collect()
    want = slow_variants(spelled)
    assert {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == want and len(got) == len(want)
    assert any(r.form and r.form != r.root for r in got)


def test_variants_of_odd_rows(odd, odd_rows, empty):
    got = variants.variants(odd).collect()
    assert {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == slow_variants([r[:2] for r in odd_rows])
    assert variants.variants(empty).collect() == []


def test_nodes_of_parts_agree():
    rng = random.Random(2)
    paths = sorted({"".join(rng.choices("ab", k=rng.randint(1, 9))) for _ in range(300)} | {"a" * 12, "a" * 13})
    for size in (1, 2, 7, 50, len(paths)):
        parts = [paths[i : i + size] for i in range(0, len(paths), size)]
        borders = variants.border_nodes([(p[0], p[-1]) for p in parts])
        number, prefix = {}, {}
        for i, part in enumerate(parts):
            nodes = variants.part_nodes(part, i, borders[i - 1] if i else None, borders[i] if i < len(borders) else None)
            for path, ids in zip(part, nodes):
                assert len(ids) == len(path) + 1
                for depth, node in enumerate(ids.tolist()):
                    assert number.setdefault(path[:depth], node) == node
                    assert prefix.setdefault(node, path[:depth]) == path[:depth]


def slow_squares(sizes, capacity):
    bins, offsets = [], []
    gaps = {}
    for size in sizes:
        best = None
        for gap in [*sorted({g for g in gaps.values() if g >= size}), capacity]:
            after = Counter(g for g in gaps.values() if g)
            if gap < capacity:
                after[gap] -= 1
            if gap > size:
                after[gap - size] += 1
            cost = sum(c * c for c in after.values())
            if best is None or cost < best[0] or cost == best[0] and gap < best[1]:
                best = cost, gap
        gap = best[1]
        chosen = max((b for b, g in gaps.items() if g == gap), default=None, key=lambda b: moved[b]) if gap < capacity else len(gaps)
        if gap == capacity and not gaps:
            moved = {}
        gaps[chosen] = gap - size
        moved[chosen] = len(bins)
        bins.append(chosen)
        offsets.append(capacity - gap)
    return bins, offsets


def test_least_squares_is_its_definition():
    rng = np.random.default_rng(6)
    for capacity in (5, 16, 33):
        for sizes in (rng.integers(1, capacity + 1, 150), np.sort(rng.integers(1, capacity + 1, 150))[::-1]):
            bins, offsets = bestfit.least_squares(sizes, capacity)
            assert (bins.tolist(), offsets.tolist()) == slow_squares(sizes.tolist(), capacity)


def check_places(rows, capacity):
    lines = defaultdict(list)
    for r in rows:
        lines[r.sequence_id].append((r.offset, r.length))
    for line in lines.values():
        at = 0
        for offset, n in sorted(line):
            assert offset == at and n > 0
            at += n
        assert at <= capacity
    return len(lines)


def test_pieces_and_places(odd, odd_rows, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(byte_tokenizer())
    done = bestfit.packed_documents(odd, byte_tokenizer())
    untouched(done, {"start", "length", "offset"})
    got = done.collect()
    want = Counter()
    for key, text, *_ in odd_rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        first = (len(ids) - 1) % 2048 + 1
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(key, piece, a, b - a, np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in got) == want
    assert check_places(got, 2048) <= 1.1 * sum(r.length for r in got) / 2048 + 1
    assert bestfit.packed_documents(empty, byte_tokenizer()).collect() == []
    small = bestfit.place(done.select("doc_id", "length"), per_cell=20).collect()
    assert len(small) == len(got) and check_places(small, 2048)


def test_ids_are_those_of_the_file():
    from tokenizers import Tokenizer

    tokenizer, ids = Tokenizer.from_file(byte_tokenizer()), bestfit.Ids(byte_tokenizer())
    assert ids.fast is not None
    rng = random.Random(1)
    texts = [
        "", " ", "a <|endoftext|> b", "<|endoftext|>", "it's we'll  I'D\n\n x\t\ty ", "a" * 30_000, " " * 50_000, "\n \n" * 20_000, "é漢字 ½²x　y\x85z\xa0",
        "퟿￿\U0001f600", words(rng, 500), "1234567 a1b2", "\x00\x01",
    ]
    texts += ["".join(rng.choices("ab 'stré\n\t.1漢 ", k=rng.randint(1, 80))) for _ in range(500)]
    for text in texts:
        assert ids(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text[:50]


def test_another_tokenizer_is_used_as_it_is(odd_rows):
    from tokenizers import Tokenizer

    from vigilog.llm.queries import word_tokenizer

    tokenizer, ids = Tokenizer.from_file(word_tokenizer()), bestfit.Ids(word_tokenizer())
    assert ids.fast is None
    assert ids("It is <|startoftext|> 12") == np.array(tokenizer.encode("It is <|startoftext|> 12", add_special_tokens=False).ids, "<u4").tobytes()
