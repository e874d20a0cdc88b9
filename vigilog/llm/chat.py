"""Conversations as training windows: turn-aligned spans under a token budget, with a loss mask.

A turn is written ``<|turn|>role<|text|>text<|end|>``. Inside roles and texts a backslash
is doubled and ``<|`` becomes ``<\\|``, so no marker can occur there and every text can be
read back exactly.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.llm.frame import col, with_positions

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CELL = 64


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def tokens_of(text: Column) -> Column:
    """The default measure: words and single signs of a text, and three marks for its turn."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")).cast("long") + 3


def _written(turn: Column) -> Column:
    return F.concat(F.lit(TURN), escape(turn["role"]), F.lit(TEXT), escape(turn["text"]), F.lit(END))


def windows(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    budget: int = 1024, history: int = 256, history_turns: int = 2, system: str = "system", target: str = "assistant", tokens=tokens_of,
) -> DataFrame:
    """One row for each window: ``key``, ``cell``, ``window``, ``n_context``, ``text``, ``tokens``, ``loss``.

    Turns stand in the order of ``turn`` (null first, then role and text, so that ties and
    repeated rows have a fixed order; each counts as a turn). Prefix sums of their tokens
    over the conversation choose the windows: a window takes whole turns while their sum
    stays within ``budget`` less the system turn and ``history``. A turn above that is a
    window alone and may exceed the budget: texts are never cut. A first turn with the role
    ``system`` opens every window; up to ``history_turns`` earlier turns follow while they
    hold at most ``history`` tokens. These ``n_context`` turns are repeats and masked. Then
    come the window's own turns, so each turn is once an own turn. ``loss`` lists (start,
    length), in code points of ``text``, of the own turns of role ``target``.

    Null role and null text are empty; a null key is one conversation; an empty table gives
    no windows; only the four named columns are read, others may have any name.

    Windows end at every ``CELL``-th turn, so at most CELL + ``history_turns`` turns meet in a
    row however long a conversation is; positions come from sums over blocks of turn numbers.
    """
    rows = turns.select(
        F.struct(col(key).alias("k")).alias("_key"), F.coalesce(col(turn).cast("long"), F.lit(-(1 << 62))).alias("_turn"),
        F.coalesce(col(role), F.lit("")).alias("role"), F.coalesce(col(text), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("_tokens", tokens(F.col("text"))).withColumn("_block", F.floor(F.col("_turn") / CELL))
    order = [F.col("_turn"), F.col("role"), F.col("text")]
    opening = F.when(F.col("role") == system, F.struct("role", "text", "_tokens"))
    placed = with_positions(rows, ["_key"], "_block", order, {"_start": F.col("_tokens")}, {"_system": opening})
    # The last turns of a cell are also history of the next one.
    cell = F.floor(F.col("_index") / CELL)
    near = F.col("_index") % CELL >= CELL - history_turns
    cells = placed.select(
        "_key", "_system", F.col("_index").alias("index"), F.col("_start").alias("start"), F.col("_tokens").alias("tokens"), "role", "text",
        F.explode(F.when(near, F.array(cell, cell + 1)).otherwise(F.array(cell))).alias("cell"),
    )
    held = cells.groupBy("_key", "cell").agg(
        F.sort_array(F.collect_list(F.struct("index", "start", "tokens", "role", "text"))).alias("_all"), F.first("_system").alias("_system")
    )
    first = F.col("cell") * CELL
    held = held.withColumn("_own", F.filter("_all", lambda t: t["index"] >= first)).where(F.size("_own") > 0)
    room = F.greatest(F.lit(1), F.lit(budget - history) - F.coalesce(F.col("_system")["_tokens"], F.lit(0))).cast("long")
    state = lambda w, end, ids: F.struct(w.alias("w"), end.alias("end"), ids.alias("ids"))

    def step(s, t):
        """A turn that would end beyond its window's room opens the next window."""
        opens = (t["start"] + t["tokens"] > s["end"]) & (F.size(s["ids"]) > 0)
        w = F.when(opens, s["w"] + 1).otherwise(s["w"])
        end = F.when(opens | (F.size(s["ids"]) == 0), t["start"] + room).otherwise(s["end"])
        return state(w, end, F.concat(s["ids"], F.array(w)))

    none = F.array().cast("array<int>")
    ids = F.aggregate("_own", state(F.lit(0), F.lit(0).cast("long"), none), step, lambda s: s["ids"])
    spread = held.withColumn("_ids", ids).withColumn("window", F.explode(F.sequence(F.lit(0), F.array_max("_ids"))))
    own = spread.withColumn("_own", F.filter("_own", lambda t, i: F.get("_ids", i) == F.col("window")))
    lead = F.get("_own", F.lit(0))
    kept = (F.col("_system").isNotNull()) & (lead["index"] > 0)
    before = lambda t: (
        (t["index"] < lead["index"]) & (t["index"] >= lead["index"] - history_turns) & (lead["start"] - t["start"] <= history) & (~kept | (t["index"] > 0))
    )
    parts = own.withColumn("_past", F.filter("_all", before)).withColumn("_kept", kept)
    context = F.concat(F.when(F.col("_kept"), _written(F.col("_system"))).otherwise(""), F.array_join(F.transform("_past", _written), ""))
    parts = parts.withColumn("_context", context).withColumn("_texts", F.transform("_own", _written))
    begins = F.aggregate(
        "_texts", F.struct(F.length("_context").alias("at"), none.alias("all")),
        lambda s, t: F.struct((s["at"] + F.length(t)).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all")), lambda s: s["all"],
    )
    spans = F.transform("_own", lambda t, i: F.struct(
        t["role"].alias("role"), (F.get("_begins", i) + len(TURN) + F.length(escape(t["role"])) + len(TEXT)).alias("start"), F.length(escape(t["text"])).alias("length"),
    ))
    learned = F.transform(F.filter("_spans", lambda s: s["role"] == target), lambda s: F.struct(s["start"], s["length"]))
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda s, t: s + t["tokens"])
    return parts.withColumn("_begins", begins).withColumn("_spans", spans).select(
        F.col("_key")["k"].alias(key), "cell", "window",
        (F.size("_past") + F.col("_kept").cast("int")).alias("n_context"),
        F.concat("_context", F.array_join("_texts", "")).alias("text"),
        (total("_own") + total("_past") + F.when(F.col("_kept"), F.col("_system")["_tokens"]).otherwise(0)).alias("tokens"),
        learned.alias("loss"),
    )


def own_turns(window: DataFrame) -> DataFrame:
    """Adds ``own``: (role, text) of each window's own turns, read back from its text."""
    marked = F.split("text", F.lit(r"<\|end\|>"), F.lit(-1))
    turns = F.slice("_marked", F.col("n_context") + 1, F.greatest(F.lit(0), F.size("_marked") - 1 - F.col("n_context")))
    read = F.transform(turns, lambda t: F.struct(
        unescape(F.substring_index(F.substr(t, F.lit(len(TURN) + 1)), TEXT, 1)).alias("role"),
        unescape(F.substring_index(t, TEXT, -1)).alias("text"),
    ))
    return window.withColumn("_marked", marked).withColumn("own", read).drop("_marked")


def learned_text(window: DataFrame) -> DataFrame:
    """Adds ``learned``: the texts under the loss mask, unescaped, read back from the window's text."""
    return window.withColumn("learned", F.transform("loss", lambda s: unescape(F.substr("text", s["start"] + 1, s["length"]))))
