import hashlib
import random

from pyspark.sql import functions as F

from vigilog.llm import chat

ODD = ["<|end|>", "\\", "\\<|", "<\\|", "a\\", "<|turn|>assistant<|text|>", "\n", "", None, "<", "|>", "\\\\<||", "é漢😀<|"]


def rows():
    rng = random.Random(2)
    out = [(1, 0, "system", "Be brief."), (1, 1, "user", "a <|end|> b"), (1, 2, "assistant", "\\ <\\| c")]
    out += [(2, i, rng.choice(["user", "assistant"]), " ".join(rng.choices("abcdef", k=rng.randint(0, 90)))) for i in range(150)]
    out += [(3, i, ["user", "assistant"][i % 2], t) for i, t in enumerate(ODD * 2)]
    out += [(4, 7, "assistant", "same"), (4, 7, "assistant", "same"), (4, None, "user", "first"), (4, 7, None, "odd role")]
    out += [(None, 0, "user", "x"), (None, 1, "assistant", "y"), (5, 0, "assistant", "word " * 5000), (6, 0, "us<|text|>er\\", "t"), (6, 1, "assistant", "u")]
    out += [(7, i, "system" if i == 0 else ["user", "assistant"][i % 2], f"turn {i} " * 30) for i in range(40)]
    return out


def ordered(all_rows):
    by = {}
    for key, turn, role, text in all_rows:
        by.setdefault(key, []).append((turn if turn is not None else -(1 << 62), role or "", text or ""))
    return {k: sorted(v) for k, v in by.items()}


def frame(spark, data):
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string").select("*", F.lit(1).alias("index"), F.lit(2).alias("_key"), F.lit(3).alias("cell"))


def test_escape_is_reversible(spark):
    df = spark.createDataFrame([(t,) for t in ODD if t is not None], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t and "<|" not in r.e


def test_windows_read_back(spark):
    data = rows()
    budget, history = 200, 60
    got = chat.learned_text(chat.own_turns(chat.windows(frame(spark, data), budget=budget, history=history))).collect()
    want = ordered(data)
    by = {}
    for r in sorted(got, key=lambda r: (r.cell, r.window)):
        by.setdefault(r.conv_id, []).append(r)
    assert set(by) == set(want)
    for key, windows in by.items():
        own = [(t.role, t.text) for w in windows for t in w.own]
        assert own == [(role, text) for _, role, text in want[key]]
        learned = [t for w in windows for t in w.learned]
        assert learned == [text for _, role, text in want[key] if role == "assistant"]
        for w in windows:
            turns = w.text.split("<|end|>")[:-1]
            assert len(turns) == w.n_context + len(w.own)
            assert w.tokens <= budget or len(w.own) == 1
            if windows.index(w) and want[key][0][1] == "system":
                assert turns[0] == f"<|turn|>system<|text|>{want[key][0][2]}"
            for s in w.loss:
                assert w.text[: s.start].endswith("<|text|>") and w.text[s.start + s.length :].startswith("<|end|>")
                assert w.text[: s.start].count("<|end|>") >= w.n_context
    assert len(by[2]) > 3 and sum(w.n_context for w in by[2]) > 0


def test_no_turns(spark):
    assert chat.windows(frame(spark, [])).collect() == []


def test_query_has_the_escaped_conversation(spark):
    from vigilog.llm.queries import QUERIES

    r = QUERIES["op3_chat_windows"](spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    said = r"\### Assistant: </turn> ok"
    assert (r.n_turns, r.loss_chars) == (2, len(said))
    assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


def test_plan_is_native(spark):
    plan = chat.windows(frame(spark, rows()))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
