"""Best-fit packing with certified bin counts.

Documents' ids are packed into sequences of at most `capacity` tokens. Only longer documents are cut, into full pieces of
which the first may be shorter. Full pieces are sequences of their own; the others go to partitions of about PART rows by a
hash of the row, each packed best-fit-decreasing in one task. A lower bound by dual feasible functions (Martello and Toth's
L2 and Fekete and Schepers' u(k)) over the partition's lengths certifies its bin count. Partitions above their bound, and
the at most half full bins of the others, exchange their pieces: those are dealt anew by another hash and packed again, as
long as that saves bins and the whole table's bound isn't met. Only counts and one histogram of `capacity` lengths come to
the driver. Each round is a table in the shared folder, so a lost executor costs its tasks alone.

Nulls: a null text is empty, a null id stays null. Every document has the end id at least, so each gives a piece. Repeated
rows are pieces of their own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm import workers
from kinweave.llm.common import Scratch
from kinweave.llm.tokens import crc, default_tokenizer, encoder, slices

PART = 50_000
SLICE = 1_000_000
#: Words that a worker keeps: fewer than tokens.KEPT_WORDS, since the pipeline's other stages leave executors little room.
KEPT = 500_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """The best of the dual feasible bounds for items of which counts[x] have length x."""
    x = np.flatnonzero(counts)
    if not len(x):
        return 0
    n = counts[x].astype(object)  # exact integers
    best = -(-int((n * x.astype(object)).sum()) // capacity)
    count, mass = np.zeros(capacity + 2, "i8"), np.zeros(capacity + 2, "i8")
    count[1 : len(counts) + 1] = np.cumsum(counts)
    mass[1 : len(counts) + 1] = np.cumsum(counts * np.arange(len(counts)))
    half = capacity // 2
    for a in range(0, half + 1):  # L2: items over capacity - a are alone, those over half each open a bin, the rest from a on fill
        alone = count[capacity + 1] - count[capacity - a + 1]
        large = count[capacity - a + 1] - count[half + 1]
        spare = large * capacity - (mass[capacity - a + 1] - mass[half + 1])
        fill = mass[half + 1] - mass[a]
        best = max(best, int(alone + large + max(0, -(-(fill - spare) // capacity))))
    for k in range(1, 33):
        up = (k + 1) * x
        value = np.where(up % capacity == 0, x * k, up // capacity * capacity).astype(object)
        best = max(best, -(-int((n * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each item, and the number of bins. Bins of equal room stand in one stack; a bit mask of the rooms
    that occur finds the tightest one."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets, n = np.zeros(len(lengths), "i8"), np.zeros(len(lengths), "i8"), 0
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i in order.tolist():
        size = int(lengths[i])
        fit = rooms >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            own = stacks[room].pop()
            if not stacks[room]:
                rooms ^= 1 << room
        else:
            room, own, n = capacity, n, n + 1
        bins[i], offsets[i] = own, capacity - room
        if left := room - size:
            stacks[left].append(own)
            rooms |= 1 << left
    return bins, offsets, n


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of n ids."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first), *[(s, capacity) for s in range(first, n, capacity)]]


def pieces(docs: DataFrame, capacity: int, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, KEPT)
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)  # texts stay as they came
            out: list[list] = [[], [], [], [], []]
            for lo, hi in slices(texts, SLICE):
                flat, sizes = enc.flat(texts.slice(lo, hi - lo), end_id)
                view, at = memoryview(flat.astype("<u4").tobytes()), 0
                for doc, n in zip(ids[lo:hi], sizes.tolist()):
                    for k, (s, m) in enumerate(cut(n, capacity)):
                        for col, v in zip(out, (doc, k, s, m, crc(view[4 * (at + s) : 4 * (at + s + m)]))):
                            col.append(v)
                    at += n
                del flat, view
            workers.trim()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(workers.tidy(run), PIECES)


def _packed(light: DataFrame, capacity: int, seed: int, parts: int) -> DataFrame:
    """row, length, part, bin, offset, fill of its bin, and its partition's bins and bound."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "row"], ascending=[False, True], kind="stable")
        size = pdf["length"].to_numpy()
        bins, offsets, n = best_fit_decreasing(size, capacity)
        fill = np.bincount(bins, size, minlength=n).astype("i8")
        bound = lower_bound(np.bincount(size, minlength=capacity + 1), capacity)
        return pd.DataFrame({"row": pdf["row"], "length": size, "part": pdf["part"], "bin": bins, "offset": offsets, "fill": fill[bins], "bins": n, "bound": bound})

    dealt = light.select("row", "length", F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(parts)).cast("int").alias("part"))
    return dealt.groupBy("part").applyInPandas(pack, "row long, length long, part int, bin long, offset long, fill long, bins long, bound long")


def pack(docs: DataFrame, capacity: int = 1024, tokenizer: str | None = None, end_id: int = 2, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    keep = Scratch(spark, "packing")
    all_pieces = keep.put(pieces(docs, capacity, tokenizer or default_tokenizer(), end_id, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "pieces")
    light = all_pieces.where(F.col("length") < capacity).select("row", "length")
    histogram = np.zeros(capacity + 1, "i8")
    for length, n in light.groupBy("length").count().collect():  # at most `capacity` rows
        histogram[length] = n
    whole = lower_bound(histogram, capacity)
    # a partition has about PART rows, so its bins are far fewer than 1 << 20; rounds have 18 bits
    number = lambda r: (F.lit(r).cast("long") * F.lit(1 << 44) + F.col("part").cast("long") * F.lit(1 << 20) + F.col("bin")).alias("sequence_id")
    settled: list[DataFrame] = []
    pool, n_pool, used = light, int(histogram.sum()), 0
    for r in itertools.count():
        if not n_pool:
            break
        parts = max(1, -(-n_pool // PART))
        now = keep.put(_packed(pool, capacity, r, parts), f"round{r}")
        if r:
            new = now.where(F.col("offset") == 0).count()
            if new >= held:  # the exchange saved nothing: what was there stays
                settled.append(before)
                pool = None
                break
            used += new - held
        else:
            used = now.where(F.col("offset") == 0).count()
        loose = (F.col("fill") < capacity) & ((F.col("bins") > F.col("bound")) | (F.col("fill") * 2 <= capacity))
        if used <= whole:
            settled.append(now.select("row", number(r), "offset"))
            break
        settled.append(now.where(~loose).select("row", number(r), "offset"))
        before = now.where(loose).select("row", number(r), "offset")
        pool = now.where(loose).select("row", "length")
        n_pool, held = now.where(loose).agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("offset") == 0).cast("long")), F.lit(0))).first()
    placed = all_pieces.where(F.col("length") >= capacity).select("row", (F.lit(1 << 62) + F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    for x in settled:
        placed = placed.unionByName(x)
    return all_pieces.join(placed, "row").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
