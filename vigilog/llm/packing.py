"""Sum-of-squares online packing of token pieces into sequences of fixed length."""

import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilog.llm.frame import col, pack, short_batches, unpack
from vigilog.storage import materialize

LENGTH = 4096
# What the tokenizer's pre-tokenizer surely keeps apart: a Latin-1 letter and an ASCII sign right after it.
SIGN = re.compile(r"[!-&(-/:-@\[-`{-~](?<=[a-zß-öø-ÿ].)")
WORD_OF = re.compile(r"[a-zß-öø-ÿ]+")
# Python's split() takes more signs for space than the tokenizer does, or means them otherwise.
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0]")
CACHE_WORDS = 500_000
BATCH = 256


class Ids:
    """Token ids of texts by a tokenizer that works word by word, each word encoded once.

    The tokenizer drops white space and lower-cases, so a text is split at its spaces, and between
    a letter and a sign, and each distinct piece encoded by the tokenizer itself. A text that holds anything beyond
    Latin-1, where lower case or composition could depend on neighbours, or an added token
    of the file, goes to it whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        """Runs of letters are encoded many at a time; a token with the word-end mark ends each."""
        words = [p for p in pieces if WORD_OF.fullmatch(p)]
        others = [p for p in pieces if not WORD_OF.fullmatch(p)]
        self.known.update(zip(others, self._encode(others)))
        for i in range(0, len(words), 1000):
            some = words[i : i + 1000]
            raw = self._encode([" ".join(some)])[0]
            cuts = [0, *(4 * (np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) + 1)).tolist()]
            if len(cuts) != len(some) + 1:
                self.known.update(zip(some, self._encode(some)))
            else:
                self.known.update(zip(some, (raw[a:b] for a, b in zip(cuts, cuts[1:]))))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        known, found, new = self.known, [None] * len(texts), {}
        if len(known) > CACHE_WORDS:
            known.clear()
        split = []
        for i, text in enumerate(texts):
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                found[i] = self._encode([text])[0]
                continue
            low = text.lower()
            if ODD_SPACE.search(text) or any(t in low for t in self.added):
                found[i] = self._encode([text])[0]
                continue
            parts = SIGN.sub(r" \g<0>", low).split()
            new.update(dict.fromkeys(set(parts).difference(known)))
            split.append((i, parts))
        self._learn(list(new))
        for i, parts in split:
            found[i] = b"".join(map(known.__getitem__, parts))
        return found


@lru_cache(maxsize=2)
def _ids(path: str) -> Ids:
    return Ids(path)


def pieces(docs: DataFrame, tokenizer: str, text: str = "text", end_id: int = 2, length: int = LENGTH) -> DataFrame:
    """Tokenizes whole texts and cuts them: ``start``, ``length``, ``ids``, ``doc_tokens`` for each piece.

    A document's ids (null text: none) are followed by ``end_id`` and cut at multiples of
    ``length``; ``ids`` is binary, little-endian unsigned 32-bit. Each row of ``docs`` is a
    document, repeated rows too; the other columns are carried, but for the text, which the
    ids replace; results replace columns of their name. An empty table gives no pieces. A very long text is held once, in one task.
    """
    names = docs.columns
    short_batches(docs.sparkSession)

    def cut(frames):
        ids_of = _ids(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for whole in frames:
            for first in range(0, len(whole), BATCH):
                pdf = whole.iloc[first : first + BATCH]
                at, out = [], []
                for i, ids in enumerate(ids_of([t or "" for t in pdf["_text"]])):
                    ids += end
                    for start in range(0, len(ids), 4 * length):
                        at.append(i)
                        out.append((start // 4, ids[start : start + 4 * length], len(ids) // 4))
                found = pd.DataFrame(out, columns=["start", "ids", "doc_tokens"])
                found["length"] = found["ids"].str.len() // 4
                yield pd.concat([pdf.drop(columns="_text").iloc[at].reset_index(drop=True), found], axis=1)

    taken = {"start", "length", "ids", "doc_tokens", text.lower()}
    carried = [c for c in names if c.lower() not in taken]
    frame = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(carried)], col(text).cast("string").alias("_text"))
    schema = ", ".join([f"c{i} {frame.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(carried))] + ["start long, ids binary, doc_tokens long, length long"])
    cut_up = frame.mapInPandas(cut, schema)
    return cut_up.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], "start", "length", "ids", "doc_tokens")


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) for each size in the order of arrival.

    The level array counts the bins filled to each level below ``capacity``. A size goes
    to the level (0: a new bin) for which the sum of squared counts grows least; ties go
    to the fullest. A full bin is closed and counts no more.
    """
    counts = np.zeros(capacity + 1, np.int64)
    bins_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, opened = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), 0
    never = np.iinfo(np.int64).max
    for i, size in enumerate(sizes):
        # Moving a bin from level h to h + size changes the sum by 2 (N[h + size] - N[h] + 1).
        ahead = counts[size:]
        growth = np.where(counts[: capacity + 1 - size] > 0, 2 * (ahead - counts[: capacity + 1 - size] + 1), never)
        growth[0] = 2 * ahead[0] + 1
        last = capacity - size
        if last and counts[last] > 0:
            growth[last] = 1 - 2 * counts[last]
        elif not last:
            growth[0] = 0
        level = last - int(np.argmin(growth[::-1]))
        if level:
            found = bins_at[level].pop()
            counts[level] -= 1
        else:
            found, opened = opened, opened + 1
        bins[i], offsets[i] = found, level
        if level + size < capacity:
            counts[level + size] += 1
            bins_at[level + size].append(found)
    return bins, offsets


def place(parts: DataFrame, length: str = "length", capacity: int = LENGTH, per_cell: int = 16384) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``: where each piece lies in sequences of ``capacity`` tokens.

    Pieces are dealt by hash to cells of about ``per_cell`` pieces and each cell is packed
    online, in the order of another hash, by ``sum_of_squares``. Only a piece's number and
    length reach Python; its row is joined back in the same partition. ``sequence_id`` is
    the cell's number times 2^32 plus the sequence's, so cells need no agreement.

    A length must be from 1 to ``capacity``. The input is written to the shared folder
    first: numbering and packing then see the same rows even if executors are lost.
    Repeated rows are packed each; an empty table gives an empty result; a result replaces
    an input column of the same name.
    """
    names = parts.columns
    base = materialize(parts.select(pack(parts), col(length).cast("long").alias("_length")), "pieces")
    cells = max(1, -(-base.count() // per_cell))
    # Two independent hashes of the whole row; equal rows are interchangeable.
    dealt = base.withColumn("_cell", F.pmod(F.xxhash64("_row"), F.lit(cells))).withColumn("_order", F.xxhash64("_row", F.lit(1)))
    numbered = dealt.withColumn("_number", F.row_number().over(Window.partitionBy("_cell").orderBy("_order", F.xxhash64("_row", F.lit(2)))))

    def pack_cell(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_number")
        bins, offsets = sum_of_squares(pdf["_length"].to_numpy(), capacity)
        return pd.DataFrame({"_cell": pdf["_cell"], "_number": pdf["_number"], "_bin": bins, "_offset": offsets})

    packed = numbered.select("_cell", "_number", "_length").groupBy("_cell").applyInPandas(pack_cell, "_cell long, _number int, _bin long, _offset long")
    sequence = F.shiftleft(F.col("_cell"), 32) + F.col("_bin")
    return unpack(numbered.join(packed, ["_cell", "_number"]), names, {"sequence_id": sequence, "offset": F.col("_offset")})


def sequences(placed: DataFrame, capacity: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``ids``, ``tokens`` (unpadded).

    Pieces are joined by offset and padded to ``capacity``, except where the length is a
    power of two. A sequence holds at most ``capacity`` ids, so a group is bounded.
    """
    grouped = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("tokens"))
    joined = F.aggregate("p.ids", F.lit(b""), lambda s, x: F.concat(s, x))
    power = F.col("tokens").bitwiseAND(F.col("tokens") - 1) == 0
    pad = F.unhex(F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()), (F.lit(capacity) - F.col("tokens")).cast("int")))
    return grouped.select("sequence_id", F.when(power, joined).otherwise(F.concat(joined, pad)).alias("ids"), "tokens")


def packed_documents(docs: DataFrame, tokenizer: str, text: str = "text", capacity: int = LENGTH) -> DataFrame:
    """Pieces of ``docs`` with their ids and places."""
    return place(pieces(docs, tokenizer, text, length=capacity), capacity=capacity)
