"""Best-fit packing: whole documents into sequences by the sum of squares over gaps."""

import json
import re
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from vigilog.llm.frame import col, short_batches
from vigilog.storage import materialize

LENGTH = 2048
# Pieces that are packed together; the last few sequences of such a cell stay open.
CELL = 65_536
BATCH = 256
# Where byte-level tokenizers cut a text before they merge (fixed, part of the file format's definition).
WORD = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The fast encoder's pattern recurses over white space; such runs go to the tokenizer itself.
LONG_GAP = re.compile(r"\s{256}")


def byte_letters() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary: itself if it prints, else the next free one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


class Ids:
    """Token ids as the tokenizer file gives them, without added special tokens.

    A plain byte-level file whose merges stand in the order of their ids is run by a faster
    encoder of the same merges; texts that hold an added token or a very long gap, and all
    texts of other files, go to the tokenizer as it is loaded.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.fast = self._same_merges(json.loads(Path(path).read_text("utf-8")))

    def _same_merges(self, file: dict):
        import tiktoken

        cut, model, letters = file["pre_tokenizer"] or {}, file["model"], byte_letters()
        self.added = [t["content"] for t in file["added_tokens"]]
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if file["normalizer"] or model["type"] != "BPE" or any(cut.get(k) != v for k, v in plain.items()):
            return None
        if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            return None
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merged = [model["vocab"].get(a + b, -1) for a, b in pairs]
        tokens = {t: i for t, i in model["vocab"].items() if t not in self.added}
        if merged != sorted(set(merged)) or len(pairs) + 256 != len(tokens) or not set("".join(tokens)) <= set(letters):
            return None
        ranks = {bytes(letters[c] for c in t): i for t, i in tokens.items()}
        return tiktoken.Encoding("merges", pat_str=WORD, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self.fast is None or any(t in text for t in self.added) or len(text) > 256 and LONG_GAP.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def _ids(path: str) -> Ids:
    return Ids(path)


def pieces(docs: DataFrame, tokenizer: str, text: str = "text", end_id: int = 0, length: int = LENGTH) -> DataFrame:
    """Tokenizes whole texts: ``piece``, ``start``, ``length``, ``ids`` for each piece of a document.

    A document's ids (null text: none) are followed by ``end_id``. Up to ``length`` ids are one
    piece; of longer documents all pieces have that length but the first, which has the rest.
    ``ids`` is binary, little-endian unsigned 32-bit. Each row of ``docs`` is a document, repeated
    rows too; the other columns are carried, but for the text, which the ids replace; results
    replace columns of their name. An empty table gives no pieces. A very long text is held once, in one task.
    """
    short_batches(docs.sparkSession)
    taken = {"piece", "start", "length", "ids", text.lower()}
    carried = [c for c in docs.columns if c.lower() not in taken]
    frame = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(carried)], col(text).cast("string").alias("_text"))
    results = StructType([StructField("piece", IntegerType()), StructField("start", LongType()), StructField("length", LongType()), StructField("ids", BinaryType())])

    def cut(batches):
        ids_of, end = _ids(tokenizer), np.array([end_id], "<u4").tobytes()
        for whole in batches:
            for first in range(0, whole.num_rows, BATCH):
                batch = whole.slice(first, BATCH)
                at, out = [], []
                for i, text in enumerate(batch.column("_text").to_pylist()):
                    ids = ids_of(text or "") + end
                    n = len(ids) // 4
                    edges = [0, *range((n - 1) % length + 1, n + 1, length)]
                    for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                        at.append(i)
                        out.append((piece, a, b - a, ids[4 * a : 4 * b]))
                kept = [batch.column(f"c{i}").take(pa.array(at, pa.int64())) for i in range(len(carried))]
                found = [pa.array([x[j] for x in out], t) for j, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([*kept, *found], [f.name for f in schema])

    schema = StructType([*frame.schema.fields[:-1], *results.fields])
    return frame.mapInArrow(cut, schema).toDF(*carried, *results.names)


def least_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) for each size in the given order.

    ``counts[g]`` is the number of open bins with a gap of g. A size goes to the gap, or to a new
    bin, for which the sum of the squared counts becomes smallest; ties go to the smallest
    gap, an open bin before a new one. A full bin is closed and counts no more.
    """
    counts = np.zeros(capacity + 1, np.int64)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, n = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), 0
    never = np.iinfo(np.int64).max
    for i, size in enumerate(np.asarray(sizes).tolist()):
        # A bin of gap g becomes one of g - size: the sum grows by 2 (N[g - size] - N[g] + 1); a closed one only leaves.
        here = counts[size:]
        growth = np.where(here > 0, 2 * (counts[: capacity + 1 - size] - here + 1), never)
        if here[0] > 0:
            growth[0] = 1 - 2 * here[0]
        growth[-1] = 2 * counts[capacity - size] + 1 if size < capacity else 0
        gap = size + int(np.argmin(growth))
        if gap < capacity:
            found = open_[gap].pop()
            counts[gap] -= 1
        else:
            found, n = n, n + 1
        bins[i], offsets[i] = found, capacity - gap
        if gap > size:
            counts[gap - size] += 1
            open_[gap - size].append(found)
    return bins, offsets


def place(parts: DataFrame, length: str = "length", capacity: int = LENGTH, per_cell: int = CELL) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``: where each piece lies in sequences of ``capacity`` tokens.

    Pieces are dealt by a hash to cells of about ``per_cell`` and each cell is packed by
    ``least_squares``, long pieces first, which leaves fewest sequences. Only a piece's number
    and length reach Python. ``sequence_id`` is the cell's number times 2^32 plus the
    sequence's, so cells need no agreement.

    A length must be from 1 to ``capacity``. The input is written to the shared folder and
    numbered there, so that a lost executor changes nothing. Repeated rows are packed each; an empty
    table gives an empty result; a result replaces an input column of the same name.
    """
    names = parts.columns
    flat = parts.select(*[col(c).alias(f"_c{i}") for i, c in enumerate(names)], col(length).cast("long").alias("_length"))
    base = materialize(flat.withColumn("_number", F.monotonically_increasing_id()), "pieces")
    cells = max(1, -(-base.count() // per_cell))

    def pack_cell(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_length", "_number"], ascending=[False, True])
        bins, offsets = least_squares(pdf["_length"].to_numpy(), capacity)
        return pd.DataFrame({"_number": pdf["_number"], "_sequence": (pdf["_cell"].to_numpy() << 32) + bins, "_offset": offsets})

    dealt = base.select("_number", "_length", F.pmod(F.xxhash64("_number"), F.lit(cells)).alias("_cell"))
    packed = dealt.groupBy("_cell").applyInPandas(pack_cell, "_number long, _sequence long, _offset long")
    kept = [F.col(f"_c{i}").alias(c) for i, c in enumerate(names) if c.lower() not in ("sequence_id", "offset")]
    return base.join(packed, "_number").select(*kept, F.col("_sequence").alias("sequence_id"), F.col("_offset").alias("offset"))


def packed_documents(docs: DataFrame, tokenizer: str, text: str = "text", end_id: int = 0, capacity: int = LENGTH) -> DataFrame:
    """Pieces of ``docs`` with their ids and places."""
    return place(pieces(docs, tokenizer, text, end_id, capacity), capacity=capacity)
