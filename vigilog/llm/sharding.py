"""Best-fit-decreasing bin packing of indivisible groups into shards."""

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.llm.frame import pack, salts, unpack, with_positions


class Rooms:
    """Bins in a balanced search tree (treap) by remaining room, then number."""

    def __init__(self):
        self.root, self.state = None, 88172645463325252

    def _priority(self) -> int:
        self.state ^= (self.state << 13) & (2**64 - 1)
        self.state ^= self.state >> 7
        self.state ^= (self.state << 17) & (2**64 - 1)
        return self.state

    def _split(self, node, key):
        """The nodes below ``key`` and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[2], right = self._split(node[2], key)
            return node, right
        left, node[1] = self._split(node[1], key)
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[3] > b[3]:
            a[2] = self._merge(a[2], b)
            return a
        b[1] = self._merge(a, b[1])
        return b

    def add(self, room: int, number: int) -> None:
        left, right = self._split(self.root, (room, number))
        self.root = self._merge(self._merge(left, [(room, number), None, None, self._priority()]), right)

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the bin with the least room that holds ``size``."""
        left, right = self._split(self.root, (size, -1))
        if right is None:
            self.root = left
            return None
        first = right
        while first[1] is not None:
            first = first[1]
        key = first[0]
        _, rest = self._split(right, (key[0], key[1] + 1))
        self.root = self._merge(left, rest)
        return key


def best_fit(sizes: Iterable[int], capacity: int) -> list[int]:
    """A bin for each size, given in falling order; a size over ``capacity`` fills a bin alone."""
    rooms, bins, opened = Rooms(), [], 0
    for size in sizes:
        found = rooms.take(size)
        if found is None:
            found, opened = (capacity, opened), opened + 1
        if found[0] > size:
            rooms.add(found[0] - size, found[1])
        bins.append(found[1])
    return bins


def balanced(sizes: list[int], shards: int) -> list[int]:
    """Bins 0 to ``shards`` - 1 for sizes in falling order, filled as evenly as best fit can.

    A size over the mean of what is left gets a shard of its own; for the others the
    least capacity is bisected for which best fit needs no more bins than there are.
    """
    alone, rest = 0, sum(sizes)
    while alone < min(shards - 1, len(sizes)) and sizes[alone] * (shards - alone) >= rest:
        rest, alone = rest - sizes[alone], alone + 1
    tail, free = sizes[alone:], shards - alone
    low, high = -(-rest // free), max(1, 2 * max([-(-rest // free), *tail[:1]]))
    fits = lambda c: max(best_fit(tail, c), default=0) < free
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return [*range(alone), *[alone + b for b in best_fit(tail, high)]]


def even_shards(docs: DataFrame, group: Column, size: Column, shards: int = 8, fine: int = 4096) -> DataFrame:
    """Puts every row into one of ``shards`` shards of nearly equal size; adds ``shard`` and ``slot``.

    Rows of equal ``group`` stay together (null is a group). Groups of at least
    1 / ``fine`` of all sizes are packed as they are; smaller ones are dealt by hash to
    ``fine`` blocks, which are packed like groups. So best fit sees at most 2 * ``fine``
    sizes, whatever the input, and these are all that reaches the driver.

    A null or negative size counts as 0. ``slot`` counts from 0 without gaps in each shard.
    Equal rows get slots of their own; an empty table gives an empty result; a result
    replaces an input column of the same name.
    """
    spark, names = docs.sparkSession, docs.columns
    base = docs.select(
        pack(docs), F.coalesce(F.sha2(group.cast("string"), 256), F.lit("")).alias("_group"),
        F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long").alias("_size"),
    )
    groups = base.groupBy("_group").agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_n"))
    total, rows = groups.agg(F.coalesce(F.sum("_bytes"), F.lit(0)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    block = F.pmod(F.xxhash64("_group"), F.lit(fine)).cast("string")
    own = F.col("_bytes") * fine >= max(1, total)
    items = groups.groupBy(F.when(own, F.col("_group")).otherwise(block).alias("_item")).agg(F.sum("_bytes").alias("b"))
    sized = sorted(((r.b, r._item) for r in items.collect()), reverse=True)
    found = pd.DataFrame({"_item": [i for _, i in sized], "_shard": balanced([b for b, _ in sized], shards)})
    placed = spark.createDataFrame(found, "_item string, _shard int")
    # Large groups are at most ``fine``, the placed items at most twice as many: both tables are bounded.
    large = groups.where(own).select("_group", F.lit(True).alias("_own"))
    dealt = (
        base.join(F.broadcast(large), "_group", "left")
        .withColumn("_item", F.when(F.col("_own"), F.col("_group")).otherwise(block))
        .join(F.broadcast(placed), "_item")
    )
    parts = salts(rows, 8)
    cell = F.xxhash64("_item", F.pmod(F.xxhash64("_row"), F.lit(parts)))
    slotted = with_positions(dealt.withColumn("_cell", cell), ["_shard"], "_cell", [F.xxhash64("_row"), F.xxhash64("_row", F.lit(1))])
    return unpack(slotted, names, {"shard": F.col("_shard"), "slot": F.col("_index").cast("long")})


def fixed_shards(docs: DataFrame, group: Column, size: Column, capacity: int, per_cell: int = 256) -> DataFrame:
    """Puts every row into shards of at most ``capacity``, as few as best fit finds; adds ``shard``.

    Groups are dealt by hash to cells of about ``per_cell`` shards, and each cell is
    packed by itself, so that about one shard in ``per_cell`` is left part full. Groups
    under 1 / 64 of a shard are first dealt to blocks of about that size, so a cell packs
    a bounded number of sizes. Only sizes meet in a task, never rows. A group over ``capacity`` has a shard alone. Nulls, equal rows, empty tables and
    clashing names: as in ``even_shards``. ``shard`` is a string, cell and number.
    """
    names = docs.columns
    base = docs.select(
        pack(docs), F.coalesce(F.sha2(group.cast("string"), 256), F.lit("")).alias("_group"),
        F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long").alias("_size"),
    )
    groups = base.groupBy("_group").agg(F.sum("_size").alias("_bytes"))
    total = groups.agg(F.coalesce(F.sum("_bytes"), F.lit(0))).first()[0]
    cells = max(1, total // (capacity * per_cell))

    def pack_cell(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_bytes", "_item"], ascending=[False, True])
        bins = best_fit([int(b) for b in pdf["_bytes"]], capacity)
        return pd.DataFrame({"_item": pdf["_item"], "_shard": pd.Series([f"{c}-{b}" for c, b in zip(pdf["_cell"], bins)], pdf.index, object)})

    grain = max(1, capacity // 64)
    blocks = max(1, total // grain)
    item = F.when(F.col("_bytes") >= grain, F.col("_group")).otherwise(F.pmod(F.xxhash64("_group"), F.lit(blocks)).cast("string"))
    items = groups.withColumn("_item", item)
    sums = items.groupBy("_item").agg(F.sum("_bytes").alias("_bytes"))
    shards = sums.withColumn("_cell", F.pmod(F.xxhash64("_item"), F.lit(cells))).groupBy("_cell").applyInPandas(pack_cell, "_item string, _shard string")
    found = items.select("_group", "_item").join(shards, "_item").select("_group", "_shard")
    return unpack(base.join(found, "_group"), names, {"shard": F.col("_shard")})
