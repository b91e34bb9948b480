"""Language-model scores by stupid backoff (Brants et al., 2007), counted over the whole corpus and joined back.

S(w | u v) = c(u v w) / c(u v) where u v w occurs at least `least` times, else BACKOFF x S(w | v), down to c(w) / N. A word
at the start of a document has only the context that stands before it. A document's score is the sum of log10 S over its words.

Relations, with n-grams by 64-bit hashes and columns packed in arrays, a row for many n-grams:
  corpus  chunk, documents, words     about CHUNK words a row
  grams   chunk, bucket, gram, n      each chunk's exploded n-grams of all orders, grouped, so a hot n-gram is one entry a chunk
  counts  bucket, gram, n             one count table for all orders, partitioned by hash of the n-gram; what occurs once is left out
  joined  chunk, bucket, n            grams joined to counts, in the order of grams
Grams and counts have the same partitioning, so the n-grams cross the network once: a bucket's task sums up the count table's part,
writes it, and joins it to the bucket's grams. The counts found go back to their chunks, where they are joined to the words and
summed per document. A gram entry takes about 5 bytes (sorted, differences), a count mostly one.

Above some 10^11 words a chunk has few n-grams in each bucket, and rows' own cost grows beside theirs.

Nulls: a null or wordless text has 0 words, score 0 and no mean. A null id stays null. Repeated rows count as often as they
stand and are scored each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm import workers
from kinweave.llm.common import Scratch
from kinweave.llm.packed import from_planes, full, narrow, planes, short, wide
from kinweave.llm.tokens import slices

CHUNK = 1_500_000
BUCKET = 1_000_000
BACKOFF = 0.4
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def chunks(docs: DataFrame) -> DataFrame:
    """n words, docs (ids), none (null ids), sizes, vocabulary (hashes), words (numbers into it) of each chunk."""

    def row(ids: list, held: list[list[bytes]]) -> pa.RecordBatch:
        names: dict[bytes, int] = {}
        flat = np.fromiter((names.setdefault(w, len(names)) for ws in held for w in ws), "<u4")
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, names), "<u8", len(names))
        parts = (np.array([x or 0 for x in ids], "<i8").tobytes(), np.array([x is None for x in ids], "u1").tobytes(), planes(np.array([len(x) for x in held])), hashes.tobytes(), planes(flat))
        return pa.RecordBatch.from_arrays([pa.array([len(flat)], pa.int64()), *[pa.array([p], pa.binary()) for p in parts]], ["n", "docs", "none", "sizes", "vocabulary", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.serve("scoring")
        ids, held, count = [], [], 0
        for b in batches:
            names, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in slices(texts):
                for d, t in zip(names[lo:hi], texts[lo:hi]):
                    ws = (t or "").encode("utf-8", "surrogatepass").split()
                    ids.append(d)
                    held.append(ws)
                    count += len(ws)
                    if count >= CHUNK:
                        yield row(ids, held)
                        ids, held, count = [], [], 0
        if ids:
            yield row(ids, held)

    return docs.mapInArrow(workers.tidy(run), "n long, docs binary, none binary, sizes binary, vocabulary binary, words binary")


class Exploded:
    """A chunk's n-grams: for each order, the keys of those that end at each word, and where there are such."""

    def __init__(self, vocabulary: bytes, words: bytes, sizes: bytes, order: int, buckets: int):
        h = np.frombuffer(vocabulary, "<u8")[from_planes(words)]
        self.sizes = from_planes(sizes).astype(np.int64)
        place = np.arange(len(h)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.there = [place >= k for k in range(order)]
        # a bucket and the rest of the hash, as many bits as there are
        bits = min(48, 64 - (buckets - 1).bit_length())
        keys = []
        for k in range(order):
            keys.append(_mixed(h if k == 0 else np.r_[np.uint64(0), keys[-1][:-1]][: len(h)] * _K1 + h * _K2))
        own = np.concatenate([key[there] for key, there in zip(keys, self.there)])
        b = np.uint64(buckets)
        own = own % b << np.uint64(bits) | own // b & np.uint64((1 << bits) - 1)
        self.keys, back, self.n = np.unique(own, return_inverse=True, return_counts=True)
        self.back = back.reshape(-1)
        self.ends = np.searchsorted(self.keys, np.arange(buckets, dtype=np.uint64) << np.uint64(bits))
        self.ends = np.r_[self.ends, len(self.keys)]
        self.rest = np.uint64((1 << bits) - 1)

    def rows(self) -> Iterator[tuple[int, bytes, bytes]]:
        """bucket, grams, n."""
        for i, (x, y) in enumerate(zip(self.ends, self.ends[1:])):
            if y > x:
                yield i, narrow(self.keys[x:y] & self.rest), short(self.n[x:y])

    def counts(self, found: np.ndarray) -> list[np.ndarray]:
        """By order: the corpus count of the n-gram that ends at each word, 0 where there is none."""
        out, at = [], 0
        for there in self.there:
            c = np.zeros(len(there))
            m = int(there.sum())
            c[there] = found[self.back[at : at + m]]
            out.append(c)
            at += m
        return out


def grams(corpus: DataFrame, order: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, v, w, s in zip(*(b.column(i).to_pylist() for i in range(4))):
                rows = list(Exploded(v, w, s, order, buckets).rows())
                for r in range(0, len(rows), 64):
                    c = list(zip(*rows[r : r + 64]))
                    yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(c[0]), pa.int64()), pa.array(c[0], pa.int32()), pa.array(c[1], pa.binary()), pa.array(c[2], pa.binary())], ["chunk", "bucket", "grams", "n"])

    return corpus.select("chunk", "vocabulary", "words", "sizes").mapInArrow(workers.tidy(run), "chunk long, bucket int, grams binary, n binary")


def counted(exploded: DataFrame) -> DataFrame:
    """The count table's rows (chunk null: grams, n) and the joined ones (chunk, n), by bucket."""

    def run(table: pa.Table) -> pa.Table:
        keys = [wide(x) for x in table.column("grams").to_pylist()]
        own = np.concatenate([full(x) for x in table.column("n").to_pylist()])
        names, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(back.reshape(-1), own).astype(np.int64)
        ends, found = np.cumsum([0, *map(len, keys)]), total[back.reshape(-1)]
        often = total > 1
        n = len(keys)
        return pa.table({
            "chunk": pa.array([None, *table.column("chunk").to_pylist()], pa.int64()),
            "bucket": pa.array([table.column("bucket")[0].as_py()] * (n + 1), pa.int32()),
            "grams": pa.array([narrow(names[often]), *[None] * n], pa.binary()),
            "n": pa.array([short(total[often]), *[short(found[a:b]) for a, b in zip(ends, ends[1:])]], pa.binary()),
        })

    return exploded.groupBy("bucket").applyInArrow(workers.tidy_group(run), "chunk long, bucket int, grams binary, n binary")


def score(docs: DataFrame, least: int = 2, order: int = 2, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, score, mean_score of every row. order: words of the longest n-grams."""
    keep = Scratch(docs.sparkSession, "scoring")
    corpus = keep.put(chunks(docs.select(F.col(id_col).cast("long"), F.col(text_col))).withColumn("chunk", F.monotonically_increasing_id()), "corpus", "zstd")
    n = corpus.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(4, n * order // (2 * BUCKET) + 1)
    counts = keep.put(counted(grams(corpus, order, buckets)), "counts")
    joined = counts.where("chunk is not null").groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for names, none, sizes, v, w, got in zip(*(b.column(i).to_pylist() for i in range(6))):
                own = Exploded(v, w, sizes, order, buckets)
                c = own.counts(np.concatenate([*(full(x["n"]) for x in got or []), np.zeros(0, np.int64)]).astype(float))
                s = np.log10(c[0] / n) if n else c[0]
                for k in range(1, order):
                    seen = np.flatnonzero(own.there[k] & (c[k] >= least))
                    s[own.there[k]] += np.log10(BACKOFF)
                    s[seen] = np.log10(c[k][seen] / c[k - 1][seen - 1])
                size = own.sizes
                sums = np.bincount(np.repeat(np.arange(len(size)), size), s, len(size)).astype(float)
                ids = pa.array(np.frombuffer(names, "<i8"), mask=np.frombuffer(none, "u1").astype(bool))
                yield pa.RecordBatch.from_arrays([ids, pa.array(size), pa.array(sums), pa.array(sums / np.maximum(size, 1), mask=size == 0)], ["doc_id", "n_words", "score", "mean_score"])

    both = corpus.join(joined, "chunk", "left").select("docs", "none", "sizes", "vocabulary", "words", "found")
    return both.mapInArrow(workers.tidy(run), "doc_id long, n_words long, score double, mean_score double")


#: DuckDB SQL for round(score, 6) and round(mean_score, 6).
SQL = r"""with w as materialized (select doc_id, unnest(ws) as w, unnest(range(1, len(ws) + 1)) as i from (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents) x),
p as materialized (select a.doc_id, a.i, a.w, b.w as v from w a left join w b on a.doc_id = b.doc_id and b.i = a.i - 1),
c1 as (select w, count(*) as n from w group by 1), c2 as (select v, w, count(*) as n from p where v is not null group by 1, 2),
s as (select p.doc_id, case when p.v is null then log10(c1.n::double / t.n) when c2.n >= 2 then log10(c2.n::double / k.n) else log10(c1.n::double / t.n) + log10(0.4) end as s from p join c1 on c1.w = p.w left join c2 on c2.v = p.v and c2.w = p.w left join c1 k on k.w = p.v cross join (select count(*) as n from w) t)
select d.doc_id, coalesce(m.n, 0) as n_words, round(coalesce(m.s, 0.0), 6) as score, round(m.s / m.n, 6) as mean_score from documents d left join (select doc_id, count(*) as n, sum(s) as s from s group by 1) m using (doc_id)"""
