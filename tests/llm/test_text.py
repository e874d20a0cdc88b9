import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import untouched, words
from vigilog.llm import chunks, language, minhash, toxicity
from vigilog.llm.components import Sets, by_group, connected, in_cells

SF = "/root/testdata/sf0.01"


# --- toxicity ----------------------------------------------------------------


def distance(a, b):
    """Edits with swaps of neighbours (optimal string alignment)."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@settings(max_examples=300, deadline=None)
@given(st.text("abcd", min_size=1, max_size=9))
def test_automaton_finds_what_edit_distance_finds(word):
    terms = {"abcd": False, "abcddcba": False, "dd": False, "bcabcab": True, "cadb": True}
    lexicon = toxicity.Lexicon(terms)
    near = []
    for t, is_open in terms.items():
        forms = [word[:k] for k in range(len(word) + 1)] if is_open else [word]
        edits = min(distance(t, w) for w in forms)
        if edits <= lexicon.allowance(t, is_open):
            near.append((edits, -len(t), t))
    found = lexicon.match(word)
    assert (found is not None) == bool(near)
    if near:
        assert found[1] == min(near)[0]


def model():
    terms = {"moron": False, "worthless": False}
    weights = {(t, f): 7.0 for t in terms for f in (" ", "")} | {(t, "~"): 5.5 for t in terms}
    return {"terms": terms, "weights": weights, "curve": (0.9, -4.5), "rows": 1}


def test_context_and_spelling_decide():
    score = lambda t: toxicity.Judge(model()).score(t)[0]
    assert score("you are a moron") > 0.7 and score("What a worthles thing, you m0ron!") > 0.7
    assert score("you moooooron") > 0.7 and score("you are worhtless and a mroon") > 0.7
    assert score('the word "moron" was once a clinical term') < 0.7
    assert score("nothing here at all") < 0.05 and score("") == 0.0
    assert score("moron " + "fine " * 20_000) == score("moron")


@pytest.mark.parametrize("stray", ['a 5" pipe', 'he said "hello there.', "„ and so on", 'the end" of it', '"'])
def test_a_stray_quote_sign_excuses_nothing(stray):
    score = lambda t: toxicity.Judge(model()).score(t)[0]
    assert score(f"{stray} {'fine ' * 100} you are a moron") > 0.7
    assert score(f"{stray} you are a moron") > 0.7
    assert score(f"you are a moron {stray}") > 0.7
    assert score(f'{stray} {"fine " * 100} they wrote "what a moron, really" on it') < 0.7
    assert score(f'{stray} the word "moron" was once a clinical term') < 0.7
    assert score("il dit « moron » sans raison") < 0.7 and score("er sagte „du moron“ dazu") < 0.7 and score('so: „worthless" hm') < 0.7


def test_scores_of_odd_rows(odd, odd_rows, empty):
    done = toxicity.with_scores(odd, model())
    untouched(done, {"score", "predicted"})
    got = done.collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 and r.predicted == 0 for r in got)
    assert toxicity.with_scores(empty, model()).collect() == []
    none = toxicity.learn(empty.select("text", F.lit(1).alias("toxic")), "text", "toxic")
    assert toxicity.with_scores(odd, none).agg(F.max("predicted")).first()[0] == 0


def test_labels_are_joined_by_mean_and_bounded(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (2, 0), (3, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.labelled(docs, labels).collect()
    assert sorted(r._label for r in got) == [0, 1]
    many = toxicity.labelled(docs, docs.select("doc_id", F.lit(1).alias("toxic")), sample_rows=500)
    assert 350 < many.count() < 650


def test_rare_terms_are_learned_beside_a_copied_text(spark):
    """One toxic text makes up a third of the rows; two slurs are rare among the toxic rows and absent from clean ones."""
    rng = random.Random(17)
    prose = words(rng, 300).split()
    line = lambda n: rng.choices(prose, k=n)
    copied = " ".join(line(20) + ["wretchoid"] + [f"ordinary{c}" for c in "abcdefgh"])
    rows = [(copied, 1)] * 1500 + [(" ".join(line(30)), 0) for _ in range(1800)]
    rows += [(" ".join(line(25) + ["scumbagger"] + line(5)), 1) for _ in range(1150)]
    rows += [(" ".join(line(25) + [slur] + line(5)), 1) for slur in ("zorgface", "klomphead") for _ in range(25)]
    learned = toxicity.learn(spark.createDataFrame(rows, "text string, toxic int").repartition(4), "text", "toxic")
    judge = toxicity.Judge(learned)
    for slur in ("scumbagger", "zorgface", "klomphead"):
        assert judge.score(" ".join([*line(20), slur]))[1] == 1
    assert judge.score(" ".join(f"ordinary{c}" for c in "abcdefgh"))[1] == 0


def test_forgotten_steps_change_no_match(monkeypatch):
    rng = random.Random(3)
    some = ["".join(rng.choices("abcdé", k=rng.randint(1, 12))) for _ in range(300)]
    terms = {"abcd": False, "abcddcba": False, "bcabcab": True}
    want = [toxicity.Lexicon(terms).match(w) for w in some]
    monkeypatch.setattr(toxicity, "KNOWN_STEPS", 20)
    small = toxicity.Lexicon(terms)
    assert [small.match(w) for w in some] == want and small.kept <= 20 + 13


def test_chance_finds_among_many_candidates_are_left(spark):
    """Toxic rows of mostly unique words: the candidates too rare to be chosen count as tried."""
    rng = random.Random(23)
    rare = lambda n: ["".join(rng.choices("abcdefghijklm", k=9)) for _ in range(n)]
    rows = [(" ".join(rare(60) + ["scumbagger"]), 1) for _ in range(40)] + [(" ".join(rare(60)), 0) for _ in range(300)]
    rows += [(" ".join(rare(60) + ["harmlessly"]), 1) for _ in range(3)] + [(" ".join(rare(60) + ["vielleicht"]), 0) for _ in range(5)]
    learned = toxicity.learn(spark.createDataFrame(rows, "text string, toxic int").repartition(4), "text", "toxic")
    assert [t for t in learned["terms"] if "scumbagger".startswith(t)]
    assert all("scumbagger".startswith(t) for t in learned["terms"])


def test_held_out_toxicity(spark):
    from vigilog.llm.queries import QUERIES, table

    got = QUERIES["op1_toxicity"](spark, SF).join(table(spark, SF, "labels"), "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in got)
    assert right / len(got) > 0.9 and not any(r.predicted and not r.toxic for r in got)


# --- language ----------------------------------------------------------------


def test_filter_holds_all_languages_of_a_gram():
    filter_ = language.Filter(["a", "b", "c"], bits=12)
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    filter_.add(grams[:200], 0)
    filter_.add(grams[100:], 1)
    found, all_ = filter_.counts(grams, np.repeat([0, 1, 2], 100), 3)
    assert all_.tolist() == [100] * 3
    assert found[1, 0] == pytest.approx(100, abs=1) and found[1, 1] == pytest.approx(100, abs=1)
    assert found[0, 1] < 5 and found[2, 0] < 5 and found[:, 2].max() == 0
    rates = filter_.false_rates()
    other = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    raw, n = filter_.counts(other, np.zeros(20_000, int), 1)
    assert raw[0].max() / n[0] < 0.01 and rates[2] == 0


def test_grams_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["Ab c", "", "  x\ny ", "é", "Ab c"]
    h, owner = language.grams(texts)
    for i, t in enumerate(texts):
        own = language.grams([t])[0]
        assert sorted(own.tolist()) == sorted(h[owner == i].tolist())
    one = language.grams(["ab"])[0]
    assert len(one) == 3 + 2  # " a", "ab", "b "; " ab", "ab "


def test_languages_of_odd_rows(odd, odd_rows, empty):
    learned = language.learn(odd)
    done = language.with_language(odd, learned)
    untouched(done, {"score"})
    got = done.collect()
    assert len(got) == len(odd_rows)
    for r in got:
        letters = r.text and re.search(r"[^\W\d_]", r.text)
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    assert language.with_language(empty, learned).collect() == []
    assert {r.lang_pred for r in language.with_language(odd, language.learn(empty)).collect()} == {"und"}


def test_more_languages_than_bits(spark):
    langs = [f"l{i:02d}" for i in range(70)]
    rows = [(f"{chr(0x4E00 + 50 * i)}{chr(0x4E01 + 50 * i + j)} " * 4, x) for i, x in enumerate(langs) for j in range(2)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    learned = language.learn(docs, share=0.4)
    assert all(r.lang == r.lang_pred for r in language.with_language(docs, learned).collect())


def test_a_copied_text_does_not_fill_the_language_sample(spark):
    """A third of all rows hold one text; drawn or not, the other texts of its language are learned."""
    rng = random.Random(4)
    line = lambda letters: " ".join("".join(rng.choices(letters, k=5)) for _ in range(20))
    hot = [(line("xyz"), "aa")] * 900
    rows = hot + [(line("abcd"), "aa") for _ in range(600)] + [(line("mnop"), "bb") for _ in range(600)]
    learned = language.learn(spark.createDataFrame(rows, "text string, lang string").repartition(5), rows_per_lang=100)
    fresh = spark.createDataFrame([(line("abcd"), "aa") for _ in range(30)] + [(line("mnop"), "bb") for _ in range(30)], "text string, lang string")
    assert all(r.lang == r.lang_pred for r in language.with_language(fresh, learned).collect())


def test_held_out_language(spark):
    from vigilog.llm.queries import QUERIES, table

    got = QUERIES["op2_language"](spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97


# --- groups and components -----------------------------------------------------


def slow_components(n, edges):
    sets = Sets(n)
    for a, b in edges:
        sets.join(a, b)
    return sets.labels().tolist()


def test_connected(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(90)] + [(7, 7)]
    got = {r.id: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = slow_components(500, edges)
    ends = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: want[x] for x in ends}
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_cells_meet_all_pairs(spark):
    import pandas as pd

    rows = spark.createDataFrame([("hot", i, 4) for i in range(60)] + [("x", 1, 1), ("x", 2, 1)] + [(f"s{i}", i, 1) for i in range(50)], "k string, v long, parts int")
    cells = in_cells(rows, "k", F.col("parts"), F.col("v")).select("k", "_i", "_j", "v")
    assert cells.groupBy("k", "_i", "_j").count().agg(F.max("count")).first()[0] < 50

    def pairs(group):
        v = sorted(group["v"])
        found = [(group["k"].iloc[0], a, b) for i, a in enumerate(v) for b in v[i + 1 :]]
        return pd.DataFrame(found, columns=["k", "a", "b"]).astype({"k": object})

    got = by_group(cells, ["k", "_i", "_j"], pairs, "k string, a long, b long").distinct().collect()
    assert Counter(r.k for r in got) == {"hot": 60 * 59 // 2, "x": 1}


def test_groups_survive_batch_borders(spark):
    import pandas as pd

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = spark.range(500).select((F.col("id") * F.col("id") % 37).alias("k"), "id")
        count = lambda g: pd.DataFrame({"k": [g["k"].iloc[0]], "n": [len(g)]})
        got = {r.k: r.n for r in by_group(rows, ["k"], count, "k long, n long").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == Counter(i * i % 37 for i in range(500))


# --- near-duplicates -----------------------------------------------------------


def shingle_set(text):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())
    w = [re.sub(rb"[A-Z]", lambda m: m[0].lower(), x) for x in w]
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(6)
    for n in (1, 2, 5, 40, 3000):
        s = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        assert len(minhash.sketch(s)) == 128 and (minhash.sketch(s) == minhash.sketch(np.sort(s)[::-1].copy())).all()
    for n in (60, 2000):
        errors = []
        for _ in range(30):
            s = np.unique(rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64))
            a, b = s[: int(1.75 * n)], s[int(0.25 * n) :]
            errors.append(float((minhash.sketch(a) == minhash.sketch(b)).mean()) - 0.75)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def brute_near(rows):
    sets = [shingle_set(t) for _, t in rows]
    edges = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    return sets, slow_components(len(rows), edges)


def check_near(df, rows):
    sets, labels = brute_near(rows)
    least = {}
    for (key, _), label in zip(rows, labels):
        if key is not None:
            least[label] = min(least.get(label, key), key)
    want = Counter((k, len(s), least.get(x), k == least.get(x)) for (k, _), s, x in zip(rows, sets, labels))
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()) == want


def test_near_duplicates_of_odd_rows(odd, odd_rows, empty):
    done = minhash.near_duplicates(odd)
    untouched(done, {"kept"})
    check_near(done, [(k, t) for k, t, *_ in odd_rows])
    assert minhash.near_duplicates(empty).collect() == []
    assert minhash.deduplicated(empty).collect() == []


def test_near_duplicates_in_large_groups(spark, monkeypatch):
    """Families whose members are linked only through others, and cells smaller than the groups."""
    monkeypatch.setattr(minhash, "CELL", 16)
    rng = random.Random(9)
    rows = []
    for family in range(3):
        base = words(rng, 150).split()
        for _ in range(60):
            text = list(base)
            for _ in range(rng.randint(0, 5)):
                text[rng.randrange(150)] = "edit%d" % rng.randrange(1000)
            rows.append((len(rows), " ".join(text)))
    drift = words(rng, 120).split()
    for i in range(40):
        drift[3 * i] = f"step{i}"
        rows.append((len(rows), " ".join(drift)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_near(minhash.near_duplicates(docs), rows)
    kept = {r.doc_id for r in minhash.deduplicated(docs).collect()}
    _, labels = brute_near(rows)
    assert kept == set({x: i for i, x in reversed(list(enumerate(labels)))}.values())


def test_one_row_of_each_component_stays(odd, odd_rows):
    got = minhash.deduplicated(odd)
    assert got.columns == odd.columns
    rows = [(k, t) for k, t, *_ in odd_rows]
    sets, labels = brute_near(rows)
    assert got.count() == sum(not s for s in sets) + len({x for s, x in zip(sets, labels) if s})


# --- repeated passages -----------------------------------------------------------


def test_chunks_cover_texts_and_shift(spark):
    rng = random.Random(3)
    passage = words(rng, 80)
    for text in (f"{words(rng, 20)} {passage} {words(rng, 5)}", f"{passage}", "x" * 3000, "漢" * 900, " ", "a"):
        data = np.frombuffer(text.encode(), np.uint8)
        starts, digests, n = chunks.chunked(data)
        assert starts[0] == 0 and (np.diff(starts) > 0).all() and len(digests) == len(starts)
        assert n.sum() == len(text.encode().split())
        for s in starts:
            data[s:].tobytes().decode()
    a = chunks.chunked(np.frombuffer(f"{words(rng, 33)} {passage} tail".encode(), np.uint8))[1]
    b = chunks.chunked(np.frombuffer(f"{words(rng, 12)}\n{passage} other end".encode(), np.uint8))[1]
    whole = chunks.chunked(np.frombuffer(passage.encode(), np.uint8))[1]
    assert len(set(a) & set(b)) >= len(whole) - 4


def test_equal_chunks_have_equal_digests_wherever_they_stand():
    rng = random.Random(11)
    seen = defaultdict(set)
    vocabulary = [words(rng, 1) for _ in range(30)]
    for _ in range(200):
        text = " ".join(rng.choices(vocabulary, k=rng.randint(1, 60))).encode()
        starts, digests, _ = chunks.chunked(np.frombuffer(text, np.uint8))
        for s, e, d in zip(starts, [*starts[1:], len(text)], digests):
            seen[int(d)].add(text[s:e])
    assert all(len(v) == 1 for v in seen.values())
    assert len({t for v in seen.values() for t in v}) == len(seen)


def test_passages_leave_later_rows(odd, odd_rows, empty):
    done = chunks.without_repeats(odd)
    untouched(done, {"removed"})
    got = done.collect()
    assert len(got) == len(odd_rows)
    texts = {k: t for k, t, *_ in odd_rows}
    for r in got:
        if r.doc_id is None:
            continue
        rest, at = "", 0
        for s in r.removed:
            rest, at = rest + texts[r.doc_id][at : s.start], s.start + s.length
        assert (r.text is None and texts[r.doc_id] is None) or rest + texts[r.doc_id][at:] == r.text
    words_of = {r.doc_id: r.removed_words for r in got if r.doc_id is not None}
    assert words_of[1] == words_of[10] == words_of[7] == 0
    assert words_of[3] == 120 and words_of[2] > 90 and words_of[11] > 45
    assert all(n == 0 for k, n in words_of.items() if k not in (2, 3, 11))
    assert chunks.without_repeats(empty).collect() == []


def test_passages_of_over_fifty_words_are_found(spark):
    rng = random.Random(21)
    rows, planted = [], {}
    for i in range(40):
        passage = words(rng, rng.randint(60, 110))
        for j in range(4):
            key = 10 * i + j
            planted[key] = passage
            rows.append((key, f"{words(rng, 60)} {passage} {words(rng, 60)}"))
    rows += [(1000 + i, words(rng, 150)) for i in range(60)]
    got = {r.doc_id: r for r in chunks.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[k].removed_words == 0 for k in got if k >= 1000 or k % 10 == 0)
    shares = [got[k].removed_words / len(p.split()) for k, p in planted.items() if k % 10]
    assert min(shares) > 0.4 and np.mean(shares) > 0.85 and max(shares) <= 1


def test_text_that_no_single_earlier_row_holds_stays(spark):
    """Later rows are mosaics of phrases and words that earlier rows hold, but never one after another."""
    rng = random.Random(33)
    phrases = [words(rng, 4) for _ in range(24)]
    common = words(rng, 25).split()
    rows = [(i, " ".join(rng.choices(phrases, k=50))) for i in range(200)]
    rows += [(500 + i, " ".join(rng.choices(common, k=150))) for i in range(200)]
    copied = " ".join(rows[7][1].split()[40:120])
    rows.append((1000, f"{words(rng, 30)} {copied} {words(rng, 30)}"))

    def pieces(text):
        w = text.split()
        return {tuple(w[i : i + chunks.LEAST_WORDS]) for i in range(len(w) - chunks.LEAST_WORDS + 1)}

    held = Counter(p for _, t in rows for p in pieces(t))
    clean = {k for k, t in rows if all(held[p] == 1 for p in pieces(t))}
    assert len(clean) >= len(rows) - 2
    got = {r.doc_id: r for r in chunks.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [k for k in sorted(clean) if got[k].removed_words] == []
    assert all(got[k].text == t for k, t in rows if k in clean)
    assert 60 < got[1000].removed_words <= 80
