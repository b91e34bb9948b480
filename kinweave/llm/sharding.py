"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups of equal texts, largest first, each enter the shard with the tightest room that still holds them; the shards' rooms are
kept in a balanced search tree. Two uses: a fixed capacity (fewest shards) and a fixed number of shards (the smallest capacity
that best-fit-decreasing can meet, found by bisection to a hundred-thousandth).

Groups of one size are interchangeable, and so are shards of one room: a run of equal groups fills a run of equal shards in one
step, which gives exactly what placing them one by one would. So the driver needs only how many groups there are of each size,
whatever the number of groups and shards. Sizes from 2^16 on are rounded up to 12 binary digits, which bounds the number of
sizes (CLASSES) and so what reaches the driver, the steps, and the runs that are broadcast. On the executors each group has a
gapless rank among those of its size, and its shard follows from the run that its rank falls into. A hot group is one row.

Nulls: a null text is an empty one and groups with the empty texts. Repeated rows and null ids are rows of their own.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import Scratch, gapless, utf8

ROW_BYTES = 16
ROWS_A_CHUNK = 200_000
EXACT, DIGITS = 1 << 16, 12
#: Sizes that there can be: the exact ones, and 2^11 for each binary length from 17 to 63.
CLASSES = EXACT + 47 * (1 << DIGITS - 1)
FINE = 100_000


@dataclass
class _Node:
    room: int
    bin: int
    rank: int
    left: "_Node | None" = None
    right: "_Node | None" = None


class RoomTree:
    """A treap of bins by (room, bin): insert, and take the bin with the least room of at least `size`, in O(log bins)."""

    def __init__(self):
        self.root: _Node | None = None
        self._seed = 1

    def _rank(self) -> int:
        self._seed = self._seed * 6364136223846793005 + 1442695040888963407 & (1 << 64) - 1
        return self._seed >> 20

    def _split(self, node, key):
        """Nodes before key, and those from key on."""
        if node is None:
            return None, None
        if (node.room, node.bin) < key:
            a, b = self._split(node.right, key)
            node.right = a
            return node, b
        a, b = self._split(node.left, key)
        node.left = b
        return a, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a.rank > b.rank:
            a.right = self._merge(a.right, b)
            return a
        b.left = self._merge(a, b.left)
        return b

    def add(self, room: int, bin: int) -> None:
        a, b = self._split(self.root, (room, bin))
        self.root = self._merge(self._merge(a, _Node(room, bin, self._rank())), b)

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns (room, bin) of the tightest fit. A bin may stand for a run of them."""
        a, b = self._split(self.root, (size, -1))
        if b is None:
            self.root = a
            return None
        node = b
        while node.left is not None:
            node = node.left
        found = (node.room, node.bin)
        _, rest = self._split(b, (node.room, node.bin + 1))
        self.root = self._merge(a, rest)
        return found


@dataclass
class Run:
    """Groups of one size, from the first-th on, `each` to a shard, in `shards` shards from `shard` on."""

    size: int
    first: int
    each: int
    shard: int
    shards: int


def best_fit_decreasing(items: list[tuple[int, int]], capacity: int, bins: int | None = None) -> list[Run] | None:
    """items (size, number of groups) in descending size. With bins: None if they don't fit into that many."""
    tree, opened, out = RoomTree(), 0, []
    width: dict[int, int] = {}  # shards in the run that starts at a shard

    def put(room: int, shard: int, shards: int) -> None:
        if room > 0 and shards:
            width[shard] = shards
            tree.add(room, shard)

    for size, number in items:
        done = 0
        while done < number:
            left = number - done
            if (fit := tree.take(size)) is None:
                room, shard, shards = capacity, opened, -(-left // max(1, capacity // size))
                opened += shards
                if size > capacity or bins is not None and opened > bins:
                    return None
            else:
                room, shard = fit
                shards = width.pop(shard)
            each = room // size
            full = min(shards, left // each)
            if full:
                out.append(Run(size, done, each, shard, full))
                put(room - each * size, shard, full)
                done += full * each
            elif left:
                out.append(Run(size, done, left, shard, 1))
                put(room - left * size, shard, 1)
                done, full = number, 1
            rest = shards - full
            if rest and fit is None and done < number:  # the last new shard takes what is left
                out.append(Run(size, done, number - done, shard + full, 1))
                put(room - (number - done) * size, shard + full, 1)
                done, full, rest = number, full + 1, rest - 1
            put(room, shard + full, rest)
    return out


def fewest(items: list[tuple[int, int]], capacity: int) -> list[Run]:
    """Fixed capacity; a group above it gets a shard of its own."""
    items, out, opened = sorted(items, reverse=True), [], 0
    while items and items[0][0] > capacity:
        size, number = items.pop(0)
        out.append(Run(size, 0, 1, opened, number))
        opened += number
    rest = best_fit_decreasing(items, capacity) or []
    return out + [Run(r.size, r.first, r.each, r.shard + opened, r.shards) for r in rest]


def even(items: list[tuple[int, int]], bins: int) -> list[Run]:
    """Fixed number of shards, sizes as equal as indivisible groups let them be.

    A group of at least the even share of what is left gets a shard of its own. For the others, the smallest capacity is
    sought at which best-fit-decreasing needs no more than the shards that are left."""
    items, out, left = sorted(items, reverse=True), [], bins
    total, alone = sum(size * n for size, n in items), 0
    while items and left > 1 and items[0][0] * left >= total:
        size, n = items[0]
        out.append(Run(size, alone, 1, bins - left, 1))
        total, left, alone = total - size, left - 1, alone + 1
        if alone == n:
            items.pop(0)
            alone = 0
    if not items:
        return out
    items[0] = (items[0][0], items[0][1] - alone)
    low = max(items[0][0], -(-total // left))
    fine = max(1, low // FINE)
    room, best = 0, None
    while (best := best_fit_decreasing(items, low + room, left)) is None:
        low, room = low + room + 1, max(fine, 4 * room)
    high = low + room
    while high - low >= fine and low < high:
        middle = (low + high) // 2
        if (found := best_fit_decreasing(items, middle, left)) is None:
            low = middle + 1
        else:
            best, high = found, middle
    shift = lambda r: r.first + (alone if r.size == items[0][0] else 0)
    return out + [Run(r.size, shift(r), r.each, r.shard + bins - left, r.shards) for r in best]


def size_class(size: Column) -> Column:
    """The size, rounded up to DIGITS binary digits from EXACT on."""
    step = F.pow(F.lit(2.0), F.greatest(F.length(F.bin(size)) - DIGITS, F.lit(0))).cast("long")
    up = size + step - 1
    return F.when(size < EXACT, size).otherwise(up - F.pmod(up, step))


def shard(docs: DataFrame, n_shards: int | None = None, capacity: int | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row; equal texts share a shard.

    n_shards: shards of near-equal bytes. capacity: the fewest shards of at most so many bytes (a larger group gets one
    of its own). Sizes are UTF-8 bytes plus 16 a row."""
    if (n_shards is None) == (capacity is None):
        raise ValueError("give n_shards or capacity")
    spark = docs.sparkSession
    keep = Scratch(spark, "sharding")
    data = utf8(F.col(text_col))
    rows = keep.put(docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(data) + ROW_BYTES).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), F.unhex(F.sha2(data, 256)).alias("digest")).withColumn("row", F.monotonically_increasing_id()), "rows")
    kind = size_class(F.col("bytes"))
    if capacity is not None:  # rounding must not lift a group over the capacity
        kind = F.when(F.col("bytes") <= capacity, F.least(kind, F.lit(capacity).cast("long"))).otherwise(kind)
    groups = keep.put(rows.groupBy("digest").agg(F.sum("size").alias("bytes")).select("digest", kind.alias("kind")), "groups")
    items = [(int(r["kind"]), int(r["n"])) for r in groups.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()]  # at most CLASSES rows
    runs = even(items, n_shards) if n_shards is not None else fewest(items, capacity)
    of = lambda r: (r.size, r.first, r.first + r.each * r.shards, r.each, r.shard)
    table = spark.createDataFrame([of(r) for r in runs], "size_ long, from long, to long, each long, start long")
    n_groups = sum(n for _, n in items)
    ranked = gapless(groups, ["kind"], [F.col("digest")], "rank", F.xxhash64("digest"), max(1, n_groups // ROWS_A_CHUNK))
    inside = (F.col("kind") == F.col("size_")) & (F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("to"))
    # each step of best fit ends a size or a run of rooms and starts two runs at most: some 3 x CLASSES rows
    at = ranked.join(F.broadcast(table), inside).select("digest", (F.col("start") + F.floor((F.col("rank") - F.col("from")) / F.col("each"))).cast("int").alias("shard"))
    placed = rows.join(at, "digest").select("doc_id", "size", "text_crc32", "shard", "row")
    n = rows.count()
    out = gapless(placed, ["shard"], [F.col("doc_id"), F.col("row")], "slot", F.xxhash64("row"), max(1, n // (ROWS_A_CHUNK * (n_shards or 1))))
    return out.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))
