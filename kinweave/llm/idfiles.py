"""Token ids in compressed binary files, by an adaptive context-mixing range coder.

Texts are encoded by a public tokenizer and written in ascending id order: files cover ranges of doc_id, and a file's rows are
segments of whole documents, each bytes in this format (little-endian):

  "KWT2", u32 documents, u32 ids, u32 blocks, u32 crc32 of all ids (u32 each), u32 crc32 of these fields and of the next two lines,
  i64 doc_id and u8 (1: null) for each document, u32 ids of each document,
  u32 ids, u32 bytes, u32 crc32 of the ids, of each block,
  the blocks' coded bytes.

A block holds BLOCK ids (the last one fewer) and its coder and model start anew, so blocks decode independently, however long a
document is. write() and read() code them one after another by IdCoder.java inside Spark's own tasks; pack_segment() and
unpack_segment() do the same, to the byte, without a session, LANES blocks at most side by side, one numpy lane each. For each id, the orders 2, 1 and 0 (a table by the
last two ids, one by the last id, and the block's prevailing id) each predict an id with a confidence. Their adaptive hit
probabilities are mixed in the logistic domain, in integers, with weights that learn online; the mixed probability drives a range
coder that codes a hit on the first candidate, a hit on the second, or an escape, which is followed by the id's size class under
adaptive order-0 counts and its remaining bits. Encoder and decoder step through the same model. Checksums of every block, segment
and head are verified when reading; a mismatch is an error. Ids are below 2^20 - 1; a larger one is an error.

Nulls: a null text is empty and has the end id alone; a null id is kept as such and comes first. Repeated rows are documents of
their own. An empty table gives files without segments. Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from kinweave.llm import javacode as java
from kinweave.llm import workers
from kinweave.llm.tokens import crc, default_tokenizer, encoder, slices

BLOCK = 2048
LANES = 2048
SEGMENT = BLOCK * LANES
SLICE = 4_000_000
SLOTS = 2048
#: Size classes of escaped ids, and how many steps one table of their shares serves.
CLASSES, TERM = 20, 64
#: A lane's shares are padded to a power of two, for a search by halves.
SHARES, _JUMPS = 32, (16, 8, 4, 2, 1)
#: The coder's interval has 48 bits, is kept to 2^32 at least, and settles 16 bits at a time.
LEAST, MASK = 1 << 32, (1 << 48) - 1
#: 16-bit words that a block can take: 12 + 12 + 19 bits an id, and what truncation costs.
MOST = 4 * BLOCK + 16


@lru_cache(1)
def _curves() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """stretch of a 12-bit probability, squash of -2047..2047, both integers, and the next confidence by 2 x confidence + right."""
    x = np.arange(-2047, 2048)
    squash = np.clip(np.rint(4096 / (1 + np.exp(-x / 256))), 1, 4095).astype(np.int32)
    stretch = np.clip(np.searchsorted(squash, np.arange(4096)), 0, 4094) - 2047
    confidence = [min(c + 1, 7) if right else c >> 1 or int(c == 0) for c in range(8) for right in (0, 1)]
    return stretch.astype(np.int32), np.clip(squash, 16, 4032), np.array(confidence, np.int32)


class Lanes:
    """The model and the coder of n blocks side by side. What the three orders have alike is held and learns as one array."""

    def __init__(self, n: int, data: list[bytes] | None = None):
        self.n, (self.stretch, self.squash, self.confidence) = n, _curves()
        zeros = lambda size, t=np.int32: np.zeros(size, t)
        self.lane = lane = np.arange(n, dtype=np.int64)
        self.slots, self.contexts = lane * SLOTS, np.arange(3 * n, dtype=np.int64).reshape(3, n) * 16
        self.table2, self.table1 = zeros(n * SLOTS), zeros(n * SLOTS)  # id << 3 | confidence
        self.id0, self.sure0 = zeros(n), zeros(n)
        self.hits, self.seconds = np.full(3 * n * 16, 1024, np.int32), np.full(n * 16, 1024, np.int32)
        self.weights = np.full((3, n), 22_000, np.int32)
        self.counts = np.ones((n, CLASSES), np.int32)
        self.shares = np.full((n, SHARES), 1 << 13, np.int64)
        self.last, self.before, self.steps = zeros(n), zeros(n), 0
        self.low, self.wide, self.spot = zeros(n, np.int64), np.full(n, MASK, np.int64), zeros(n, np.int64)
        self.decode = data is not None
        self.width = MOST if data is None else max(map(len, data), default=0) // 2 + 4
        if data is None:
            self.words = np.zeros(n * MOST, "<u2")
        else:
            self.words = np.frombuffer(b"".join(x.ljust(2 * self.width, b"\0") for x in data), "<u2")
            self.code = zeros(n, np.int64)
            for _ in range(3):
                self.code = self.code << 16 | self.words[lane * self.width + self.spot]
                self.spot += 1

    def settle(self, k: int, at: np.ndarray | None = None) -> None:
        """Shifts out (or in) the words that are settled in the first k lanes, or in the lanes `at`, until their intervals are wide
        enough."""
        low, wide = (self.low[:k], self.wide[:k]) if at is None else (self.low.take(at), self.wide.take(at))
        same = (low ^ low + wide) < LEAST
        move = np.flatnonzero(same | (wide < LEAST))
        at = move if at is None else at.take(move)
        while len(at):
            low, wide, same = low.take(move), wide.take(move), same.take(move)
            wide = np.where(same, wide, -low & LEAST - 1) << 16
            spot = self.spot.take(at)
            word = at * self.width + np.minimum(spot, self.width - 1)  # a damaged block may run past its end
            if self.decode:
                self.code[at] = (self.code.take(at) << 16 | self.words.take(word)) & MASK
            else:
                self.words[word] = low >> 32
            self.spot[at] = spot + 1
            low = low << 16 & MASK
            self.low[at], self.wide[at] = low, wide
            same = (low ^ low + wide) < LEAST
            move = np.flatnonzero(same | (wide < LEAST))
            at = at.take(move)

    @staticmethod
    def _value(code: np.ndarray, low: np.ndarray, part: np.ndarray, most) -> np.ndarray:
        """The value up to `most` that lies in the interval cut to such parts. Both sides are below 2^53, so the quotient is exact."""
        return np.minimum((((code - low) & MASK) / part).astype(np.int64), most)

    def step(self, k: int, ids: np.ndarray | None) -> np.ndarray:
        """Codes (or decodes, without ids) the next id of the first k lanes, and learns."""
        if self.steps % TERM == 0:
            self._terms()
        self.steps += 1
        last, before = self.last[:k], self.before[:k]
        far = last * 40503
        s1 = self.slots[:k] + (far >> 4 & SLOTS - 1)
        s2 = self.slots[:k] + (far + before * 30011 >> 3 & SLOTS - 1)
        e2, e1 = self.table2.take(s2), self.table1.take(s1)
        i2, c2, i1, c1, i0, c0 = e2 >> 3, e2 & 7, e1 >> 3, e1 & 7, self.id0[:k], self.sure0[:k]
        new2, new1 = c2 == 0, c1 == 0
        a = np.where(new2, np.where(new1, i0, i1), i2)
        same1 = a == i1
        b = np.where(same1, i0, i1)
        d2, d1 = c2 << 1, c1 << 1
        inner = np.empty((3, k), np.int32)
        np.add(d2, same1, out=inner[0])
        np.add(d1, same1, out=inner[1])
        np.add(np.minimum(c0, 7) << 1, a == i0, out=inner[2])
        places = self.contexts[:, :k] + inner
        x1 = places[1] - 16 * self.n
        q = self.hits.take(places)
        t = self.stretch.take(q)
        w = self.weights[:, :k]
        parts = w * t
        dot = (parts[0] + parts[1] + parts[2] >> 16) + 2047
        p = self.squash.take(dot, mode="clip")
        left = 4096 - p
        second = self.seconds.take(x1)
        pb = np.minimum(np.maximum(left * second >> 12, 1), left - 8)
        pb *= a != b
        wide = self.wide[:k] >> 12
        if ids is None:
            v = self._value(self.code[:k], self.low[:k], wide, 4095)
            missed = v >= p
            gone = v >= p + pb
            out = np.where(missed, b, a)
        else:
            missed = ids != a
            gone = missed & (ids != b)
            out = ids
        missed_, gone_ = missed.astype(np.int32), gone.astype(np.int32)
        self.low[:k] += (p * missed_ + pb * gone_) * wide
        self.wide[:k] = wide * (p + missed_ * (pb - p) + gone_ * (left - 2 * pb))
        out = self._escape(np.flatnonzero(gone), out, k)
        hit = 1 - missed_ << 12
        w += t * (hit - p) >> 8
        np.minimum(np.maximum(w, -131_072, out=w), 131_072, out=w)
        self.hits[places] = q + (hit - q >> 5)
        self.seconds[x1] = second + missed_ * ((1 - gone_ << 12) - second >> 5)
        self.table2[s2] = np.where(new2, out, i2) << 3 | self.confidence.take(d2 + (i2 == out))
        self.table1[s1] = np.where(new1, out, i1) << 3 | self.confidence.take(d1 + (i1 == out))
        right = i0 == out
        kept = right | (c0 > 0)
        self.sure0[:k] = np.minimum(np.maximum(c0 + (right.astype(np.int32) << 1) - 1, 0), 255)
        self.id0[:k] = np.where(kept, i0, out)
        self.before[:k] = last
        self.last[:k] = out
        return out

    def _terms(self) -> None:
        """Each lane's shares of the classes, of 4096 parts, one part a class at least."""
        ends = np.cumsum(self.counts, 1)
        self.shares[:, 0] = 0
        self.shares[:, 1 : CLASSES + 1] = ends.astype(np.int64) * (4096 - CLASSES) // ends[:, -1:] + np.arange(1, CLASSES + 1)
        self.counts = np.where(ends[:, -1:] > 400, self.counts + 1 >> 1, self.counts)

    def _escape(self, at: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
        """Size class of id + 1 under adaptive counts, then its other bits. Settles all lanes."""
        if not len(at):
            self.settle(k)
            return ids
        shares, row = self.shares.ravel(), at * SHARES
        low, part = self.low.take(at), self.wide.take(at) >> 12
        if self.decode:
            v = self._value(self.code.take(at), low, part, 4095)
            spot = row
            for jump in _JUMPS:  # the last share that is at most v
                spot = spot + jump * (shares.take(spot + jump) <= v)
            kind = spot - row
        else:
            own = ids.take(at).astype(np.int64) + 1
            kind = (own.astype(np.float64).view(np.int64) >> 52) - 1023
            spot = row + kind
        start = shares.take(spot)
        self.low[at] = low + start * part
        self.wide[at] = part * (shares.take(spot + 1) - start)
        self.settle(k)
        low, part = self.low.take(at), self.wide.take(at) >> kind
        rest = self._value(self.code.take(at), low, part, (1 << kind) - 1) if self.decode else own - (1 << kind)
        self.low[at] = low + rest * part
        self.wide[at] = part
        self.settle(k, at)
        if self.decode:
            ids = ids.copy()
            ids[at] = (1 << kind) + rest - 1
        self.counts.ravel()[at * CLASSES + kind] += 8
        return ids


def compress(ids: np.ndarray) -> list[tuple[int, bytes]]:
    """(ids, bytes) of each block."""
    if len(ids) and ids.max() >= (1 << CLASSES) - 1:
        raise ValueError(f"an id is not below 2^{CLASSES} - 1")
    out = []
    for first in range(0, len(ids), BLOCK * LANES):
        part = ids[first : first + BLOCK * LANES]
        n = -(-len(part) // BLOCK)
        grid = np.zeros((n, BLOCK), np.int32)
        grid.ravel()[: len(part)] = part
        grid = np.ascontiguousarray(grid.T)
        lanes, rest = Lanes(n), len(part) - (n - 1) * BLOCK
        for t in range(BLOCK):
            k = n if t < rest else n - 1
            if not k:
                break
            lanes.step(k, grid[t, :k])
        words = lanes.words.reshape(n, MOST)
        for i in range(n):
            low = int(lanes.low[i])
            tail = np.array([low >> 32, low >> 16 & 0xFFFF, low & 0xFFFF], "<u2")
            out.append((BLOCK if i < n - 1 else rest, words[i, : lanes.spot[i]].tobytes() + tail.tobytes()))
    return out


def expand(blocks: list[tuple[int, bytes]]) -> np.ndarray:
    out = []
    for first in range(0, len(blocks), LANES):
        part = blocks[first : first + LANES]
        n, rest = len(part), part[-1][0]
        lanes = Lanes(n, [x for _, x in part])
        grid = np.zeros((BLOCK, n), "<u4")
        for t in range(BLOCK):
            k = n if t < rest else n - 1
            if not k:
                break
            grid[t, :k] = lanes.step(k, None)
        out.append(np.ascontiguousarray(grid.T).ravel()[: (n - 1) * BLOCK + rest])
    return np.concatenate([*out, np.zeros(0, "<u4")])


def pack_segment(docs: list[tuple[int | None, int]], ids: np.ndarray) -> bytes:
    """docs: (doc_id, its number of ids), of ids in that order."""
    data = ids.astype("<u4").tobytes()
    blocks = compress(ids)
    names = _names([d for d, _ in docs], np.array([n for _, n in docs]))
    heads = np.array([(n, len(x), crc(data[4 * BLOCK * i : 4 * BLOCK * i + 4 * n])) for i, (n, x) in enumerate(blocks)], "<u4").tobytes()
    head = struct.pack("<4I", len(docs), len(ids), len(blocks), crc(data))
    return b"".join([b"KWT2", head, struct.pack("<I", crc(head + names + heads)), names, heads, *[x for _, x in blocks]])


_NAME = np.dtype([("doc_id", "<i8"), ("none", "u1")])


def _names(ids: list[int | None], sizes: np.ndarray) -> bytes:
    return np.array([(d or 0, d is None) for d in ids], _NAME).tobytes() + sizes.astype("<u4").tobytes()


def unpack_segment(data: bytes) -> tuple[list[int | None], np.ndarray, bytes]:
    """doc_ids, each one's number of ids, and all ids (u32 each); raises where a checksum differs."""
    if data[:4] != b"KWT2" or len(data) < 24:
        raise ValueError("not a segment")
    n_docs, n_ids, n_blocks, check, told = struct.unpack_from("<5I", data, 4)
    at = 24 + 13 * n_docs + 12 * n_blocks
    if at > len(data) or crc(data[4:20] + data[24:at]) != told:
        raise ValueError("the segment's head is damaged")
    names = np.frombuffer(data, _NAME, n_docs, 24)
    sizes = np.frombuffer(data, "<u4", n_docs, 24 + 9 * n_docs).astype(np.int64)
    heads = np.frombuffer(data, "<u4", 3 * n_blocks, 24 + 13 * n_docs).reshape(-1, 3).tolist()
    blocks = []
    for n, size, _ in heads:
        blocks.append((n, data[at : at + size]))
        at += size
    if at != len(data):
        raise ValueError("the segment has another length")
    ids = expand(blocks).astype("<u4").tobytes()
    for i, (n, _, own) in enumerate(heads):
        if crc(ids[4 * BLOCK * i : 4 * BLOCK * i + 4 * n]) != own:
            raise ValueError(f"block {i} is damaged")
    if len(ids) != 4 * n_ids or zlib.crc32(ids) != check:
        raise ValueError("the segment is damaged")
    return [None if none else d for d, none in names.tolist()], sizes, ids


def _register(spark: SparkSession) -> None:
    """Makes the functions that code and decode whole segments, as pack_segment and unpack_segment do, known to the session."""
    told = {"BLOCK": BLOCK, "SLOTS": SLOTS, "CLASSES": CLASSES, "TERM": TERM, "MOST": MOST, "CHUNK_DOCS": 8192, "CHUNK_IDS": 1 << 18}
    told |= {name: " ".join(map(str, x.tolist())) for name, x in zip(("STRETCH", "SQUASH", "CONFIDENCE"), _curves())}
    rows = "array<struct<place: bigint, doc_id: bigint, ids: binary>>"
    java.register(spark, "IdCoder.java", told, {"kinweave_pack": ("kinweave.IdCoder$Pack", "binary"), "kinweave_unpack": ("kinweave.IdCoder$Unpack", "array<binary>"), "kinweave_documents": ("kinweave.IdCoder$Documents", rows)})


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, *, id_col: str = "doc_id", text_col: str = "text") -> None:
    tokenizer = tokenizer or default_tokenizer()
    _register(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, number = encoder(tokenizer), TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        held: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        count = 0

        def row() -> pa.RecordBatch:
            data = [_names(names, np.concatenate(sizes)), np.concatenate(held).astype("<u4").tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([number], pa.int64()), *[pa.array([x], pa.binary()) for x in data]], ["part", "segment", "docs", "ids"])

        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            for lo, hi in slices(texts, SLICE):
                flat, n = enc.flat(texts[lo:hi], end_id)
                ends, at = np.cumsum(n), 0
                while at < len(n):  # as many documents as fill the segment, one at least
                    before = int(ends[at - 1]) if at else 0
                    to = max(at + 1, int(np.searchsorted(ends, before + SEGMENT - count, side="right")))
                    names += ids[lo + at : lo + to]
                    sizes.append(n[at:to])
                    held.append(flat[before : int(ends[to - 1])])
                    count += int(ends[to - 1]) - before
                    at = to
                    if count >= SEGMENT or at < len(n):
                        yield row()
                        names, held, sizes, count, number = [], [], [], 0, number + 1
        if names:
            yield row()

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    own.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text")).mapInArrow(workers.tidy(run), "part long, segment long, docs binary, ids binary").select("part", "segment", F.call_function("kinweave_pack", "docs", "ids").alias("data")).write.mode("overwrite").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """part, segment, place, doc_id, ids (binary, u32 each): every document as it is in the files. Chunks bound what is held at once."""
    _register(spark)
    chunks = spark.read.parquet(path).select("part", "segment", F.explode(F.call_function("kinweave_unpack", "data")).alias("chunk"))
    return chunks.select("part", "segment", F.inline(F.call_function("kinweave_documents", "chunk")))


def described(read_back: DataFrame, keep) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document."""
    own = keep.put(read_back.select("part", "segment", "place", "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")), "described")
    sums = own.groupBy("part", "segment").agg(F.sum("n_tokens").alias("n"))  # a row for each segment of about SEGMENT ids
    before = Window.orderBy("part", "segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part", "segment", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("from"))
    inside = Window.partitionBy("part", "segment").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = own.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(starts, ["part", "segment"]).select("doc_id", (F.col("from") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
