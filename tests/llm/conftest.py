import random

import pytest

CLASHES = "_row _id _n _set _number _cell size copies shard slot score predicted start length offset removed n_links kept text_2 _text _size".split()


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source): nulls, blanks, one very long text, repeated rows, near copies, a shared passage."""
    rng = random.Random(5)
    passage = words(rng, 70)
    base = words(rng, 120)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, base, "en", "a"), (2, " ".join(near), "en", "a"), (3, base, "de", "b"), (3, base, "de", "b"),
        (4, None, "en", "a"), (5, "", "en", None), (6, " \t\n", None, "b"), (None, "no key here", "en", "a"),
        (None, None, None, None), (7, words(rng, 60_000), "de", "b"), (8, "one two", "en", "a"), (9, "ONE Two", "en", "c"),
        (10, f"{words(rng, 40)} {passage} {words(rng, 40)}", "en", "c"), (11, f"{words(rng, 30)}\n{passage}\n{words(rng, 9)}", "en", "c"),
        (12, "ééé あい <|end|> \\ <\\| 漢字漢字 x" * 3, "fr", "é"), (13, "a" * 5000, "en", "a"),
    ]
    return rows + [(100 + i, words(rng, rng.randint(1, 200)), rng.choice(["en", "de"]), rng.choice("abc")) for i in range(60)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows with columns whose names the operators use inside or return."""
    df = spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string").repartition(3)
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES]).cache()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


def untouched(result, taken):
    """Clashing columns that the operator does not return keep their values."""
    for c in CLASHES:
        if c not in taken:
            assert {r[0] for r in result.select(f"`{c}`").distinct().collect()} == {f"own {c}"}
