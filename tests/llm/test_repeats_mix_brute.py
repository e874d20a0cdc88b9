"""The passage and mixture operators against plain restatements."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.llm.conftest import words
from vigilog.llm import chunks, mixing


def removed_and_kept(row, text):
    """The stretches taken out, after checking that the rest is what the row holds now."""
    gone, at, rest = [], 0, []
    for start, length in row.removed:
        rest.append(text[at:start])
        gone.append(text[start : start + length])
        at = start + length
    assert "".join(rest) + text[at:] == row.text
    return gone


def test_only_what_an_earlier_row_holds_goes_and_planted_passages_do(spark):
    rng = random.Random(21)
    passages = [words(rng, n) for n in [*range(51, 111), *range(51, 111)]]
    rows = []
    for passage in passages:
        for _ in range(2):
            rows.append((len(rows), f"{words(rng, rng.randint(0, 60))} {passage}\n{words(rng, rng.randint(1, 60))}"))
    common = [words(rng, 6) for _ in range(30)]
    # Texts put together from short common pieces: nothing in them may go.
    rows += [(len(rows) + i, " ".join(rng.sample(common, 12))) for i in range(40)]
    text_of = dict(rows)
    got = {r.doc_id: r for r in chunks.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    left = []
    for key, row in got.items():
        gone = removed_and_kept(row, text_of[key])
        for stretch in gone:
            own = stretch.split()
            held = [i for i in range(len(own) - 23) if any(" ".join(own[i : i + 24]) in " ".join(text_of[k].split()) for k in range(key))]
            covered = {w for i in held for w in range(i, i + 24)}
            assert covered == set(range(len(own))), "every removed word lies in 24 words that an earlier row holds in one piece"
        if key >= 2 * len(passages):
            assert not gone
        elif key % 2 == 0:
            assert not gone
        else:
            n = len(passages[key // 2].split())
            left.append(max(0, n - sum(len(g.split()) for g in gone)) / n)
    assert sum(x < 0.5 for x in left) >= 0.96 * len(left) and sum(left) / len(left) < 0.2


def test_hot_null_and_repeated_keys(spark, monkeypatch):
    """With short lists as with one list, and each row cleaned by its own key's rule."""
    rng = random.Random(22)
    passages = [words(rng, 80) for _ in range(6)]
    rows = [(0, passages[0]), (1, f"{passages[1]} {passages[2]}")]
    rows += [(None, f"{words(rng, 20)} {rng.choice(passages)} {words(rng, 5)}") for _ in range(40)]
    rows += [(7, f"{words(rng, 20)} {rng.choice(passages)} {words(rng, 5)}") for _ in range(40)]
    rows += [(None, rows[5][1])] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = Counter((r.doc_id, r.text) for r in chunks.without_repeats(docs).collect())
    monkeypatch.setattr(chunks, "ROWS_PER_SALT", 4)
    assert Counter((r.doc_id, r.text) for r in chunks.without_repeats(docs).collect()) == plain
    kept = [t for (key, t), n in plain.items() if key is None for p in passages[:3] if p in t]
    assert not kept, "null is the largest key, so an earlier row keeps its passage and those of null keys go"
    assert all(p in rows[0][1] + rows[1][1] for p in passages[:3])


def test_draws_are_those_of_a_plain_systematic_sampler(spark):
    rng = random.Random(23)
    rows = [(i, rng.choice(["a", "b", "c", None, "d"]), rng.choice([0, 1, 5, 40, 300])) for i in range(700)] + [(1000 + i, "few", 50 * i) for i in range(4)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, w long").repartition(4), F.col("w")).collect()
    by_source = defaultdict(list)
    for r in got:
        by_source[r.source].append(r)
    for own in by_source.values():
        size, target = own[0].source_size, own[0].target
        assert size == sum(r.size for r in own)
        rate = min(3.0, target / size)
        # Systematic sampling takes floor or ceiling of the rate of each row, and of the rate of any stretch in order.
        assert all(int(rate) <= r.copies <= -int(-rate // 1) for r in own)
        for low in sorted({r.size for r in own}):
            part = [r for r in own if r.size >= low]
            assert abs(sum(r.copies for r in part) - rate * len(part)) < 1 + 1e-6
        largest = max(r.size for r in own)
        assert abs(sum(r.copies * r.size for r in own) - target) <= largest
