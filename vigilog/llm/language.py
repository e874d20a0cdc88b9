"""Language identification with bit-sliced Bloom filters over character n-grams."""

import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.llm.frame import col, pack, short_batches, unpack

SIZES = (2, 3)
HASHES = 3
LETTER = re.compile(r"[^\W\d_]")
BATCH = 200
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _scrambled(h: np.ndarray, seed: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX[seed % 3]
    return h ^ (h >> np.uint64(29))


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the texts, and the text of each.

    Letters are lower-cased; every run of other signs is one blank, and so are both ends.
    """
    codes = np.frombuffer("\n".join(["", *[t.lower().replace("\n", " ") for t in texts], ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.cumsum(codes == 10) - 1
    blank = ~_letters()[codes]
    kept = ~(blank & np.concatenate([[False], blank[:-1]]) & (codes != 10))
    codes, owner, blank = codes[kept], owner[kept], blank[kept]
    codes = np.where(blank, np.uint64(32), codes.astype(np.uint64))
    hashes, of = [], []
    for n in SIZES:
        h = np.full(len(codes) - n + 1, n, np.uint64)
        for i in range(n):
            h = (h + codes[i : len(codes) - n + 1 + i]) * MIX[i]
            h ^= h >> np.uint64(32)
        # An n-gram belongs to a text if it holds a letter of it and does not reach past the blank that ends it.
        inside = (owner[: len(h)] == owner[n - 1 :]) | (blank[n - 1 :] & (owner[n - 1 :] == owner[: len(h)] + 1))
        inside &= ~(blank[: len(h)] & blank[n - 1 :] & (n == 2))
        hashes.append(h[inside])
        of.append(owner[: len(h)][inside])
    return np.concatenate(hashes), np.concatenate(of)


class Filter:
    """One Bloom filter for each language, sliced: a position holds a bit for each language.

    An n-gram sets its language's bit at ``HASHES`` positions; the AND of the masks there
    names all languages that contain it, and now and then one that does not. How often is
    known from how full a language's slice is.
    """

    def __init__(self, langs: list[str], bits: int = 20):
        self.langs, self.shift = langs, np.uint64(64 - bits)
        self.masks = np.zeros((-(-max(1, len(langs)) // 64), 1 << bits), np.uint64)

    def _places(self, h: np.ndarray) -> list[np.ndarray]:
        return [(_scrambled(h, s) * MIX[(s + 1) % 3]) >> self.shift for s in range(HASHES)]

    def add(self, h: np.ndarray, lang: int) -> None:
        for at in self._places(h):
            self.masks[lang // 64][at] |= np.uint64(1 << (lang % 64))

    def false_rates(self) -> np.ndarray:
        full = [float(np.mean((self.masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1))) for i in range(len(self.langs))]
        return np.array(full) ** HASHES

    def counts(self, h: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """For each text and language the n-grams found, corrected for false positives; and all n-grams of each text."""
        all_ = np.bincount(owner, minlength=texts)[:texts].astype(float)
        places = self._places(h)
        found = np.empty((texts, len(self.langs)))
        rates = self.false_rates_kept
        for plane, mask in enumerate(self.masks):
            hit = mask[places[0]]
            for at in places[1:]:
                hit &= mask[at]
            for i in range(plane * 64, min(len(self.langs), plane * 64 + 64)):
                bit = (hit >> np.uint64(i - plane * 64)) & np.uint64(1)
                found[:, i] = np.bincount(owner[bit.astype(bool)], minlength=texts)[:texts]
        return np.maximum(0.0, (found - all_[:, None] * rates) / (1.0 - rates)), all_

    @property
    def false_rates_kept(self) -> np.ndarray:
        if not hasattr(self, "_rates"):
            self._rates = self.false_rates()
        return self._rates


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", rows_per_lang: int = 1000, share: float = 0.02) -> Filter:
    """Learns a ``Filter`` from at most about ``rows_per_lang`` distinct texts of each language, chosen by a hash of the text.

    Copies count once, so a text of a third of all rows neither fills the sample nor makes it
    larger. A language contains an n-gram that at least ``share`` of its texts (and two) hold. Rows
    with null text or language teach nothing. Only n-grams above that share reach the
    driver: as many as rows hold on average, over ``share``, for each language.
    """
    known = docs.where(col(text).isNotNull() & col(lang).isNotNull()).select(col(text).alias("text"), col(lang).cast("string").alias("lang"))
    known = known.withColumn("_hash", F.xxhash64("text"))
    # A shuffle of hashes alone; texts are shuffled for those drawn only.
    rows = {r.lang: r["count"] for r in known.select("lang", "_hash").distinct().groupBy("lang").count().collect()}
    langs = sorted(rows)
    spark = docs.sparkSession
    shares = spark.createDataFrame([(x, min(1.0, rows_per_lang / rows[x])) for x in langs], "lang string, part double")
    drawn = known.join(F.broadcast(shares), "lang").where(F.pmod("_hash", F.lit(1 << 30)) < F.col("part") * (1 << 30))
    some = drawn.groupBy("lang", "_hash").agg(F.first("text").alias("text")).select("text", "lang")

    def count(frames):
        for pdf in frames:
            for x, part in pdf.groupby("lang"):
                held = []
                for t in part["text"]:
                    held.append(np.unique(grams([t])[0]))
                h, n = np.unique(np.concatenate(held), return_counts=True)
                yield pd.DataFrame({"lang": x, "gram": h.view(np.int64), "n": n})
                yield pd.DataFrame({"lang": x, "gram": [0], "n": [len(part)]})

    counted = some.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = counted.where("gram = 0").select("lang", F.col("n").alias("rows"))
    common = counted.join(F.broadcast(totals), "lang").where((F.col("n") >= F.col("rows") * share) & ((F.col("n") >= 2) | (F.col("rows") < 4)) & (F.col("gram") != 0))
    found = common.select("lang", "gram").toPandas()
    filter_ = Filter(langs)
    for i, x in enumerate(langs):
        filter_.add(found.loc[found["lang"] == x, "gram"].to_numpy(np.int64).view(np.uint64), i)
    return filter_


def with_language(docs: DataFrame, model: Filter, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``, the share of a text's n-grams that the language contains.

    Only the text is read, whole. Null texts and texts without a letter are ``und`` with
    score 0, and so is every text if nothing was learned; ties go to the language whose name
    sorts first. Repeated rows agree; an empty table gives an empty result; a result
    replaces an input column of the same name. A very long text is judged alone.
    """
    short_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judged(some: list[str]) -> list[tuple[str, float]]:
        filter_ = sent.value
        found, of = filter_.counts(*grams(some), len(some))
        best = np.argmax(found, axis=1)
        return [(filter_.langs[b], float(min(1.0, found[i, b] / max(1.0, of[i])))) for i, b in enumerate(best)]

    @F.pandas_udf("lang_pred string, score double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        out = [("und", 0.0)] * len(texts)
        values = list(texts)
        usable = [i for i, t in enumerate(values) if t and LETTER.search(t)] if sent.value.langs else []
        for first in range(0, len(usable), BATCH):
            some = usable[first : first + BATCH]
            for i, x in zip(some, judged([values[i] for i in some])):
                out[i] = x
        return pd.DataFrame(out, columns=["lang_pred", "score"]).astype({"lang_pred": object})

    found = docs.select(pack(docs), judge(col(text).cast("string")).alias("_found"))
    return unpack(found, docs.columns, {"lang_pred": F.col("_found.lang_pred"), "score": F.col("_found.score")})
