"""Self-join of documents by the Jaccard similarity of their word n-grams, size-aware and heavy-light.

A document is the set of its distinct n-word shingles (fewer words: the whole sequence is one). Two documents link when
their sets' similarity is at least num / den. Equal sets are one node from the start, so copies cost one row each.

Inverted lists. Every set's shingles go to the hash bucket of their list once, packed. Only the entries of lists that hold two
sets or more come back to their sets, with the list's length; the others can't be shared.

Heavy sets scan lists: of a set of size p, c = ceil(num p / den) shingles must be shared with any partner, so of its p - c + 1
rarest ones (by list length) at least one is, and these lists are scanned. A set with as many shingles of its own as that has
no partner and goes. Passages that many documents share have long lists and come last, so they are scanned only by sets that
hold little else.

Light sets are found by fixed-size subsets: with sizes p and q an overlap of c = ceil(num (p + q) / (num + den)) is needed,
so both emit a key for each subset of size c of the shingles that have lists. The boundary goes by cost: a set is light while
its subsets are no more than the entries in the lists that it would scan, by the mean length of the lists as measured.

Sets that meet in a list are joined to candidate classes (connected components, on the executors). Each class comes together
in one task, or in pairs of blocks where it is over BLOCK shingles, and is joined exactly there: every set's inverted lists are
scanned and the overlaps counted, so no pairs leave the task, only links along a spanning forest and counts. What crosses the
network is about 7 bytes a shingle, 15 more for a shared one, and each candidate's text once.

Shingles are 64-bit hashes of their words; sets and texts are told apart by 128-bit digests.

Nulls: a null or wordless text has an empty set and links with nothing. A null id stays null and never becomes a class id
unless its class has no other. Repeated rows link as copies. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm import workers
from kinweave.llm.common import Scratch, sieve, sift
from kinweave.llm.links import Union, components
from kinweave.llm.packed import narrow, wide
from kinweave.llm.tokens import slices

FLUSH = 1_000_000
BUCKET = 2_000_000
BLOCK = 1_500_000
SALTED = 1_000_000
KEPT_WORDS = 200_000
_WORDS: dict[bytes, int] = {}
workers.keeps("jaccard", _WORDS.clear)
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD1B54A32D192ED03, 0xABC98388FB8FAC03))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    workers.serve("jaccard")
    cut = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    known = _WORDS
    if len(known) > KEPT_WORDS:
        known.clear()
    for ws in cut:
        for w in set(ws).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
    out = []
    for ws in cut:
        k = len(ws)
        ids = np.fromiter(map(known.__getitem__, ws), np.uint64, k)
        span = min(n, k)
        if not span:
            out.append(ids)
            continue
        s = np.full(k - span + 1, span, np.uint64)
        for j in range(span):
            s = s * _ODD[0] + ids[j : k - span + 1 + j] * _ODD[1 + j % 7]
        out.append(np.unique(mixed(s)))
    return out


def digest_of(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def node_of(digest: bytes) -> int:
    """The routing id; two sets with one id only share a class of candidates."""
    return int.from_bytes(digest[:8], "little", signed=True)


def code_of(text):
    """A text's 128-bit digest; null for null."""
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


class Rule:
    """Sizes, overlaps and keys for a similarity of num / den. light: the size up to which sets go by subsets."""

    def __init__(self, num: int, den: int, light: int = 0):
        self.num, self.den, self.light = num, den, light

    def by_cost(self, length: float) -> "Rule":
        """With the boundary for lists of that mean length."""
        light = 0
        while self.subsets(light + 1) <= self.rarest(light + 1) * length:
            light += 1
        return Rule(self.num, self.den, light)

    def need(self, p: int, q: int) -> int:
        return -(-self.num * (p + q) // (self.num + self.den))

    def partners(self, p: int) -> range:
        return range(-(-self.num * p // self.den), self.den * p // self.num + 1)

    def rarest(self, p):
        """How many of a set's p shingles hold one that any partner shares."""
        return p - -(-self.num * p // self.den) + 1

    @lru_cache(None)  # noqa: B019
    def overlaps(self, p: int, light: int | None = None) -> list[int]:
        """Sizes of the subsets that a set of size p emits; light: for partners or own sizes up to light only."""
        return sorted({c for q in self.partners(p) if (light is None or min(p, q) <= light) and (c := self.need(p, q)) <= min(p, q)})

    def subsets(self, p: int) -> int:
        return sum(comb(p, c) for c in self.overlaps(p))

    def subset_keys(self, s: np.ndarray, p: int) -> np.ndarray:
        """Keys of a set of size p whose shingles with lists are s."""
        total, keys = s.sum(dtype=np.uint64), [np.zeros(0, np.uint64)]
        for c in self.overlaps(p, self.light):
            gone = len(s) - c
            if gone >= 0:
                parts = np.array([total]) if gone == 0 else total - s if gone == 1 else total - np.array([s[list(x)].sum(dtype=np.uint64) for x in combinations(range(len(s)), gone)], np.uint64)
                keys.append(mixed(parts * _ODD[2] + np.uint64(c)))
        return np.concatenate(keys)

    def keys(self, nodes: np.ndarray, sizes: np.ndarray, shingles: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys and nodes from entries (node, size of its set, shingle, length of its list), all of a node's together."""
        order = np.lexsort((shingles, lengths, nodes))
        nodes, sizes, shingles = nodes[order], sizes[order].astype(np.int64), shingles[order]
        starts = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]])[: len(nodes)]
        held = np.diff(np.r_[starts, len(nodes)])
        rank = np.arange(len(nodes)) - np.repeat(starts, held)
        # shingles without a list are the rarest; one more key, for a set's own shingles may share an entry
        scanned = self.rarest(sizes) + 1 - (sizes - np.repeat(held, held))
        heavy = (sizes > self.light) & (rank < scanned)
        keys, owners = [mixed(shingles[heavy] ^ _ODD[3])], [nodes[heavy]]
        for at in np.flatnonzero(-(-self.num * sizes[starts] // self.den) <= self.light).tolist():
            own = self.subset_keys(shingles[starts[at] : starts[at] + held[at]], int(sizes[starts[at]]))
            keys.append(own)
            owners.append(np.full(len(own), nodes[starts[at]]))
        return np.concatenate(keys), np.concatenate(owners)


def _described(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, code (of the text), n_shingles, digest, node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            sizes, digests, nodes = [], [], []
            for lo, hi in slices(texts):
                for s in shingle_sets(texts[lo:hi], n):
                    sizes.append(len(s))
                    digests.append(digest_of(s) if len(s) else None)
                    nodes.append(node_of(digests[-1]) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(nodes, pa.int64())], ["doc_id", "code", "n_shingles", "digest", "node"])

    return docs.mapInArrow(workers.tidy(run), "doc_id long, code binary, n_shingles long, digest binary, node long")


def _bits(buckets: int) -> int:
    return min(48, 64 - (buckets - 1).bit_length())


def _entries(texts: DataFrame, n: int, buckets: int) -> DataFrame:
    """Entries of inverted lists, packed: bucket, shingles (the rest of the hash), at (index into nodes), nodes, sizes."""
    bits = _bits(buckets)

    def packed(held: list[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        nodes, sizes = np.array([x[0] for x in held], "<i8"), np.array([len(x[1]) for x in held], "<u4")
        s, at = np.concatenate([x[1] for x in held]), np.repeat(np.arange(len(held), dtype="<u2"), sizes)
        own = s % np.uint64(buckets) << np.uint64(bits) | s // np.uint64(buckets) & np.uint64((1 << bits) - 1)
        order = np.argsort(own, kind="stable")
        own, at = own[order], at[order]
        ends = np.r_[np.searchsorted(own, np.arange(buckets, dtype=np.uint64) << np.uint64(bits)), len(own)]
        rows = []
        for i, (x, y) in enumerate(zip(ends, ends[1:])):
            if y > x:
                used, local = np.unique(at[x:y], return_inverse=True)
                rows.append((i, narrow(own[x:y] & np.uint64((1 << bits) - 1)), local.astype("<u2").tobytes(), nodes[used].tobytes(), sizes[used].tobytes()))
        for r in range(0, len(rows), 256):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[r : r + 256]), (pa.int32(), *[pa.binary()] * 4))], ["bucket", "shingles", "at", "nodes", "sizes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, seen = [], 0, set()
        for b in batches:
            t = b.column(0).to_pylist()
            for lo, hi in slices(t):
                for s in shingle_sets(t[lo:hi], n):
                    node = node_of(digest_of(s)) if len(s) else None
                    if node is None or node in seen:  # a copy in this task
                        continue
                    if len(seen) < 200_000:
                        seen.add(node)
                    if held and (count + len(s) > FLUSH or len(held) == 65_535):
                        yield from packed(held)
                        held, count = [], 0
                    held.append((node, s))
                    count += len(s)
        if held:
            yield from packed(held)

    return texts.mapInArrow(workers.tidy(run), "bucket int, shingles binary, at binary, nodes binary, sizes binary")


_SHARED = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.float64())


def _shared(entries: DataFrame, buckets: int) -> DataFrame:
    """The entries of lists of two sets or more, dealt by node: to, bucket, shingles, nodes, sizes, lengths; n entries and their parts of lists."""

    def run(table: pa.Table) -> pa.Table:
        keys, nodes, sizes = [], [], []
        for k, a, v, p in zip(*(table.column(c).to_pylist() for c in ("shingles", "at", "nodes", "sizes"))):
            at = np.frombuffer(a, "<u2")
            keys.append(wide(k))
            nodes.append(np.frombuffer(v, "<i8")[at])
            sizes.append(np.frombuffer(p, "<u4")[at])
        keys, nodes, sizes = np.concatenate(keys), np.concatenate(nodes), np.concatenate(sizes)
        order = np.argsort(keys, kind="stable")
        keys, nodes, sizes = keys[order], nodes[order], sizes[order]
        more = np.zeros(len(keys) + 1, bool)
        more[1:-1] = keys[1:] == keys[:-1]
        several = more[:-1] | more[1:]
        keys, nodes, sizes = keys[several], nodes[several], sizes[several]
        order = np.lexsort((nodes, keys))
        keys, nodes, sizes = keys[order], nodes[order], sizes[order]
        once = np.r_[True, (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])][: len(keys)]  # a set may come from several tasks
        keys, nodes, sizes = keys[once], nodes[once], sizes[once]
        _, which, n = np.unique(keys, return_inverse=True, return_counts=True)
        length = n[which.reshape(-1)]
        keys, nodes, sizes, length = (x[length > 1] for x in (keys, nodes, sizes, length))
        to = nodes.view(np.uint64) % np.uint64(buckets)
        order = np.argsort(to, kind="stable")  # keys ascend in each part
        cuts = np.searchsorted(to[order], np.arange(buckets + 1, dtype=np.uint64))
        rows = []
        for i, (x, y) in enumerate(zip(cuts, cuts[1:])):
            if y > x:
                own = order[x:y]
                few = np.minimum(length[own], 65_535)
                rows.append((i, table.column("bucket")[0].as_py(), narrow(keys[own]), nodes[own].tobytes(), sizes[own].tobytes(), few.astype("<u2").tobytes(), len(own), float((1 / few).sum())))
        columns = list(zip(*rows)) if rows else [()] * 8
        return pa.table([pa.array(c, t) for c, t in zip(columns, _SHARED)], names=["to", "bucket", "shingles", "nodes", "sizes", "lengths", "n", "lists"])

    return entries.groupBy("bucket").applyInArrow(workers.tidy_group(run), "to int, bucket int, shingles binary, nodes binary, sizes binary, lengths binary, n long, lists double")


def _lists(shared: DataFrame, rule: Rule, buckets: int) -> DataFrame:
    """key, node: the lists that each set scans, and its subsets."""
    bits = _bits(buckets)

    def run(table: pa.Table) -> pa.Table:
        shingles = np.concatenate([wide(k) | np.uint64(b << bits) for k, b in zip(table.column("shingles").to_pylist(), table.column("bucket").to_pylist())])
        nodes, sizes, lengths = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("nodes", "<i8"), ("sizes", "<u4"), ("lengths", "<u2")))
        keys, owners = rule.keys(nodes, sizes, shingles, lengths)
        return pa.table({"key": keys.view(np.int64), "node": owners})

    return shared.groupBy("to").applyInArrow(workers.tidy_group(run), "key long, node long")


def _met(lists: DataFrame) -> DataFrame:
    """a, b: links that join all nodes which share a key, by way of the smallest one; long lists in parts."""
    parts = max(1, -(-lists.count() // SALTED))
    dealt = lists.withColumn("part", F.pmod(F.xxhash64("node"), F.lit(parts)))
    in_part = dealt.groupBy("key", "part").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n"))
    whole = in_part.groupBy("key").agg(F.min("head").alias("first"), F.sum("n").alias("all")).where("all > 1")
    heads = in_part.join(whole, "key")
    inner = dealt.join(heads.where("n > 1").select("key", "part", "head"), ["key", "part"]).select(F.col("head").alias("a"), F.col("node").alias("b"))
    return inner.unionByName(heads.select(F.col("first").alias("a"), F.col("head").alias("b"))).where("a != b").distinct()


def overlapping(sets: list[np.ndarray], rule: Rule, left: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """For each set, the later ones that it links with. left: only pairs of one of the first `left` sets and one of the rest.

    Each set's inverted lists are scanned and counted; shingles in one set alone have no list."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")  # owners ascend inside a list
    flat, owner = flat[order], owner[order]
    first = np.r_[True, flat[1:] != flat[:-1]]
    starts = np.flatnonzero(first)
    ends = np.r_[starts[1:], len(flat)]
    which = np.cumsum(first) - 1
    at = np.arange(len(flat))
    more = at + 1 < ends[which]  # entries with later ones in their list
    lo, hi, own = at[more] + 1, ends[which[more]], owner[more]
    by = np.argsort(own, kind="stable")
    lo, hi, own = lo[by], hi[by], own[by]
    cuts = np.searchsorted(own, np.arange(n + 1))
    for i in range(n if left is None else left):
        a, b = lo[cuts[i] : cuts[i + 1]], hi[cuts[i] : cuts[i + 1]]
        if not len(a):
            continue
        lengths = b - a
        spots = np.repeat(a - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(int(lengths.sum()))
        found, shared = np.unique(owner[spots], return_counts=True)
        ok = (rule.num + rule.den) * shared >= rule.num * (sizes[i] + sizes[found])
        if left is not None:
            ok &= found >= left
        if ok.any():
            yield i, found[ok]


def _joined(texts: DataFrame, n: int, rule: Rule) -> DataFrame:
    """From class, left block, right block, block, text, copies: digest, other digest and its weight of each link's end, thinned.

    Returns kind 0: a, b digests along a spanning forest of the task's links; kind 1: a digest and the number of documents that it links with."""

    def run(table: pa.Table) -> pa.Table:
        t, copies, blocks = table.column("text").to_pylist(), table.column("copies").to_pylist(), table.column("block").to_pylist()
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        seen: dict[bytes, tuple[np.ndarray, int, int]] = {}
        for x, y in slices(t):
            for s, c, b in zip(shingle_sets(t[x:y], n), copies[x:y], blocks[x:y]):
                seen.setdefault(digest_of(s), (s, c, b))
        names = sorted(seen, key=lambda d: (seen[d][2] != lo, d))
        left = None if lo == hi else sum(seen[d][2] == lo for d in names)
        counts, union = np.zeros(len(names), "i8"), Union()
        weight = np.array([seen[d][1] for d in names], "i8")
        if len(names) > 1 and (left is None or 0 < left < len(names)):
            for i, found in overlapping([seen[d][0] for d in names], rule, left):
                counts[i] += weight[found].sum()
                counts[found] += weight[i]
                for j in found.tolist():
                    union.join(i, j)
        out = [(0, names[r], names[x], 0) for x in union.up if (r := union.find(x)) != x] + [(1, d, None, int(c)) for d, c in zip(names, counts) if c]
        kinds, a, b, w = zip(*out) if out else ((), (), (), ())
        return pa.table({"kind": pa.array(kinds, pa.int32()), "a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "n": pa.array(w, pa.int64())})

    return texts.groupBy("class", "lo", "hi").applyInArrow(workers.tidy_group(run), "kind int, a binary, b binary, n long")


def _classes(docs: DataFrame, words: int, num: int, den: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Each row's doc_id, code, n_shingles and digest; and each set's class: digest, root, first (its class's first row), n_links."""
    spark = docs.sparkSession
    keep, rule = Scratch(spark, "jaccard"), Rule(num, den)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), code_of(F.col(text_col)).alias("code"), F.col(text_col).alias("text"))
    known = keep.put(_described(own, words), "described")
    full = known.where("digest is not null")
    entries = full.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    buckets = max(4, -(-entries // BUCKET))
    shared = keep.put(_shared(_entries(own.select("text"), words, buckets), buckets), "shared")
    n, n_lists = shared.agg(F.coalesce(F.sum("n"), F.lit(1)), F.coalesce(F.sum("lists"), F.lit(1.0))).first()
    rule = rule.by_cost(n / n_lists)
    lists = keep.put(_lists(shared, rule, buckets), "lists")
    keep.drop("shared")
    met = components(_met(lists), keep, "met")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "code"))
    sets = keep.put(full.groupBy("digest", "node").agg(first.alias("first"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles")), "sets")
    # one text of each candidate set, with the number of its rows
    candidates = keep.put(sets.join(met.withColumnRenamed("root", "class"), "node").select("digest", "node", "first.code", "copies", "n_shingles", "class"), "candidates")
    sizes = candidates.groupBy("class").agg(F.sum("n_shingles").alias("mass"), F.count(F.lit(1)).alias("sets")).where("sets > 1")
    sizes = sizes.select("class", F.when(F.col("mass") > BLOCK, F.ceil(F.col("mass") / (BLOCK // 2))).otherwise(F.lit(1)).cast("int").alias("blocks"))
    wanted = candidates.join(sizes, "class").select("code", "copies", "class", "blocks", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int").alias("block")).dropDuplicates(["code"])
    wanted = keep.put(wanted, "wanted")
    near = sift(own.select("code", "text"), "code", sieve(wanted.select("code")), "near").where("near").drop("near")
    texts = near.groupBy("code").agg(F.first("text").alias("text")).join(wanted, "code")  # copies of a text fall together before the shuffle
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(F.col("block"), j).alias("lo"), F.greatest(F.col("block"), j).alias("hi")))
    spread = texts.select("class", "block", "text", "copies", F.explode(pairs).alias("p")).select("class", "p.lo", "p.hi", "block", "text", "copies")
    found = keep.put(_joined(spread, words, rule), "found")
    forest = found.where("kind = 0")
    roots = components(forest.select(F.xxhash64("a").alias("x"), F.xxhash64("b").alias("y")), keep, "joined")
    members = forest.select(F.explode(F.array("a", "b")).alias("digest")).distinct().withColumn("at", F.xxhash64("digest")).join(roots.withColumnRenamed("node", "at"), "at").select("digest", "root")
    counts = found.where("kind = 1").groupBy(F.col("a").alias("digest")).agg(F.sum("n").alias("others"))
    named = sets.join(members, "digest", "left").join(counts, "digest", "left").withColumn("root", F.coalesce("root", F.xxhash64("digest")))
    named = keep.put(named.select("digest", "root", "first", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "named")
    heads = named.groupBy("root").agg(F.min("first").alias("first"))
    return known, named.drop("first").join(heads, "root")


def join(docs: DataFrame, words: int = 4, num: int = 85, den: int = 100, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, n_links of every row."""
    known, classes = _classes(docs, words, num, den, id_col, text_col)
    per_set = classes.select("digest", F.col("first.doc_id").alias("component_id"), "n_links")
    return known.join(per_set, "digest", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, all columns as they were: the one with the smallest id. Rows without words all stay."""
    known, classes = _classes(docs, words, num, den, id_col, text_col)
    keep = Scratch(docs.sparkSession, "one")
    rows = known.where("digest is not null").select("doc_id", "code", "digest").join(classes.select("digest", "root", "first"), "digest")
    many = rows.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = keep.put(rows.join(many, "root").select("doc_id", "code", "first"), "shared")
    firsts = shared.select(F.col("first.doc_id").alias("__id"), F.col("first.code").alias("__code")).distinct()
    coded = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("own"), code_of(F.col(text_col)).alias("code"))
    coded = sift(coded, "code", sieve(shared.select("code")), "near")
    alone = coded.where("not near").select("row")  # most rows, which need no shuffle
    near = coded.where("near")
    kept = near.join(firsts, F.col("own").eqNullSafe(F.col("__id")) & (F.col("code") == F.col("__code")), "left_semi").groupBy("own", "code").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")).select("row")
    other = near.join(shared.select(F.col("code").alias("__other")).distinct(), F.col("code") == F.col("__other"), "left_anti").select("row")
    return alone.unionByName(kept).unionByName(other).select("row.*")


#: DuckDB SQL for the rows of join() with its defaults, by the inverted lists of all shingles.
SQL = r"""
with recursive w as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws
    from documents
),
s as materialized (
    select doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < 4 then [array_to_string(ws, ' ')]
        else [array_to_string(ws[i : i + 3], ' ') for i in range(1, len(ws) - 2)] end) as shingles
    from w
),
one as materialized (select min(doc_id) as id, any_value(shingles) as shingles, len(any_value(shingles)) as n, count(*) as copies from s group by list_sort(shingles)),
e as materialized (select id, n, unnest(shingles) as shingle from one),
met as materialized (
    select a.id as a, b.id as b from e a join e b on a.shingle = b.shingle and a.id <> b.id and 100 * b.n >= 85 * a.n and 100 * a.n >= 85 * b.n
    group by a.id, b.id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reach as (select id as a, id as b from one where n > 0 union select r.a, m.b from reach r join met m on m.a = r.b),
roots as (select a, min(b) as root from reach group by 1),
counts as (select a, sum(copies) as others from met join one on one.id = met.b group by 1)
select s.doc_id, len(s.shingles)::bigint as n_shingles, coalesce(r.root, s.doc_id) as component_id,
    case when len(s.shingles) = 0 then 0 else o.copies - 1 + coalesce(c.others, 0) end::bigint as n_links
from s join one o on list_sort(o.shingles) = list_sort(s.shingles) left join roots r on r.a = o.id left join counts c on c.a = o.id
"""
