"""Near-duplicate vectors by a forest of random-projection trees.

Vectors with equal labels and equal values are one node from the start. Each of TREES trees splits the nodes of a label by
random directions at medians; nodes within a margin of the median go to both sides. A pair at the threshold lies
sqrt(2 (1 - threshold) / d) apart along a random direction in the mean, and the margin is MARGIN / 2 times that to each side, so
a pair is parted only where it lies over MARGIN times its mean distance apart and just astride. Nodes within a leaf are
compared exactly, in double precision. A pair is lost only if every tree parts it.

A label of at most GROUP nodes is one task's work, all trees of it. A larger one is split tree by tree, in rounds: each round
fits up to LEVELS levels of each group over GROUP nodes on about SAMPLE of its own nodes (those with the smallest hashes, by
task), and routes all its nodes, until no group is over GROUP. The trees' lower levels are split inside the tasks with all their rows.
A group that no direction divides is compared in whole, in pairs of blocks of GROUP nodes.

A task returns a spanning forest of the links that it found, never pairs. The forests are joined to components; each component's
nodes are then compared once more, in blocks, to count every node's links, so links of two nodes that no tree brought together
but that others connect count too.

Vectors that are null, empty, zero, or hold null or non-finite components, and those with a null label, link with nothing.
Vectors of unequal length don't link. Repeated rows are rows of their own, linked as copies. A null id stays null; a class's
id is its smallest id that isn't null. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import Scratch
from kinweave.llm.links import components

TREES = 10
LEAF = 256
GROUP = 4096
SAMPLE = 1024
LEVELS = 4
MARGIN = 1.5
#: A direction divides a group if neither side keeps more than this share.
DIVIDED = 0.85
KEY = ["label", "dim", "tree", "leaf"]


def direction(d: int, *seed: int) -> np.ndarray:
    v = np.random.default_rng(seed).standard_normal(d)
    return v / np.sqrt(v @ v)


def _unit(rows: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors in double precision, from components as they are stored."""
    x = np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)
    top = np.abs(x).max(1, keepdims=True)
    x = x / top
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _read(vectors: DataFrame, kind: str) -> DataFrame:
    """vec_id, key (16 bytes, null where the vector links with nothing), label, vec (its components as bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, vecs = [], []
            for v, label in zip(b.column(2), b.column(1).to_pylist()):
                key = vec = None
                if label is not None and v.is_valid and len(v) and not v.values.null_count:
                    x = np.asarray(v.values.to_numpy(zero_copy_only=False), kind)
                    if np.isfinite(x).all() and x.any():
                        vec = x.tobytes()
                        name = label.encode("utf-8", "surrogatepass")
                        key = hashlib.blake2b(len(name).to_bytes(8, "little") + name + vec, digest_size=16).digest()
                keys.append(key)
                vecs.append(vec)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), b.column(1), pa.array(vecs, pa.binary())], ["vec_id", "key", "label", "vec"])

    return vectors.mapInArrow(run, "vec_id long, key binary, label string, vec binary")


def leaves(x: np.ndarray, margin: float, *seed: int) -> Iterator[np.ndarray]:
    """Index sets, with overlaps, of at most LEAF rows each, or of more where no direction divides them."""
    todo, count = [np.arange(len(x))], 0
    while todo:
        own = todo.pop()
        if len(own) <= LEAF:
            yield own
            continue
        for _ in range(3):
            count += 1
            p = x[own] @ direction(x.shape[1], 7, count, *seed)
            p -= np.median(p)
            left, right = own[p <= margin], own[p >= -margin]
            if max(len(left), len(right)) <= DIVIDED * len(own):
                todo += [left, right]
                break
        else:
            yield own


def _margin(d: int, threshold: float) -> float:
    return MARGIN / 2 * float(np.sqrt(2 * (1 - threshold) / d))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each of n rows reaches by the links a, b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(up := root[root], root):
            root = up
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def plant(x: np.ndarray, n: int, margin: float, *seed: int) -> tuple[np.ndarray, np.ndarray]:
    """LEVELS levels for a group of n rows of which x is a sample: by place in the tree (root 1, children 2 i and 2 i + 1) the
    attempt whose direction divides it and its median. Attempt -1: small enough, or too few in the sample; -2: none divides it."""
    attempts, medians = np.full(1 << LEVELS, -1, np.int64), np.zeros(1 << LEVELS)
    parts = {1: np.arange(len(x))}
    for i in range(1, 1 << LEVELS):
        own = parts.get(i)
        if own is None or len(own) < 32 or n * len(own) <= GROUP * len(x):
            continue
        attempts[i] = -2
        for attempt in range(3):
            p = x[own] @ direction(x.shape[1], *seed, i, attempt)
            m = np.median(p)
            left, right = own[p <= m + margin], own[p >= m - margin]
            if max(len(left), len(right)) <= DIVIDED * len(own):
                attempts[i], medians[i] = attempt, m
                parts[2 * i], parts[2 * i + 1] = left, right
                break
    if n > GROUP and attempts[1] == -1:
        attempts[1] = -2
    return attempts, medians


def route(x: np.ndarray, attempts: np.ndarray, medians: np.ndarray, margin: float, *seed: int) -> Iterator[tuple[np.ndarray, int, bool]]:
    """Rows, place and whether it is to be compared in whole, for each place where the tree ends."""
    parts = {1: np.arange(len(x))}
    for i in range(1, 2 << LEVELS):
        if (own := parts.pop(i, None)) is None or not len(own):
            continue
        attempt = int(attempts[i]) if i < len(attempts) else -1
        if attempt < 0:
            yield own, i, attempt == -2
            continue
        p = x[own] @ direction(x.shape[1], *seed, i, attempt) - medians[i]
        parts[2 * i], parts[2 * i + 1] = own[p <= margin], own[p >= -margin]


def _margin(d: int, threshold: float) -> float:
    return MARGIN / 2 * float(np.sqrt(2 * (1 - threshold) / d))


def _planted(sample: DataFrame, threshold: float, kind: str) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        x = _unit(table.column("vec").to_pylist(), kind)
        tree, leaf, n = (table.column(c)[0].as_py() for c in ("tree", "leaf", "n"))
        attempts, medians = plant(x, n, _margin(x.shape[1], threshold), tree, leaf)
        return table.select(KEY).slice(0, 1).append_column("attempts", pa.array([attempts.tobytes()], pa.binary())).append_column("medians", pa.array([medians.tobytes()], pa.binary()))

    return sample.groupBy(*KEY).applyInArrow(run, "label string, dim int, tree int, leaf long, attempts binary, medians binary")


def _routed(rows: DataFrame, threshold: float, kind: str) -> DataFrame:
    """rows with the attempts and medians of their group (null: to be compared in whole) to rows with the next leaf and whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            groups: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*(b.column(c).to_pylist() for c in KEY))):
                groups.setdefault(key, []).append(i)
            for (_, dim, tree, leaf), own in groups.items():
                part = b.take(pa.array(own))
                if not part.column("attempts")[0].is_valid:
                    ends = [(np.arange(len(own)), 1, True)]
                else:
                    attempts, medians = (np.frombuffer(part.column(c)[0].as_py(), t) for c, t in (("attempts", np.int64), ("medians", np.float64)))
                    ends = route(_unit(part.column("vec").to_pylist(), kind), attempts, medians, _margin(dim, threshold), tree, leaf)
                for at, place, whole in ends:
                    out = part.take(pa.array(at))
                    n = len(at)
                    yield pa.RecordBatch.from_arrays([*(out.column(c) for c in ("label", "dim", "tree")), pa.array(np.full(n, leaf << LEVELS + 1 | place)), out.column("node"), pa.array(np.full(n, whole))], [*KEY, "node", "whole"])

    return rows.select(*KEY, "node", "vec", "attempts", "medians").mapInArrow(run, "label string, dim int, tree int, leaf long, node long, whole boolean")


def _split(nodes: DataFrame, threshold: float, trees: int, keep: Scratch, kind: str) -> DataFrame:
    """Groups to compare: label, dim, tree (null: all of them), leaf, node, vec, n (rows of the group), whole."""
    sizes = nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    rows = nodes.select("label", "dim", "node", "vec").join(sizes, ["label", "dim"])
    done = rows.where(F.col("n") <= GROUP).select("label", "dim", F.lit(None).cast("int").alias("tree"), F.lit(1).cast("long").alias("leaf"), "node", "vec", "n", F.lit(False).alias("whole"))
    if not sizes.where(F.col("n") > GROUP).limit(1).count():
        return done
    # places in trees are written without the vectors, which join them again where they are needed
    vectors, ends = nodes.select("node", "vec"), None
    todo = rows.where(F.col("n") > GROUP).select("label", "dim", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(1).cast("long").alias("leaf"), "node", "n", "vec")
    for r in itertools.count():
        sample = todo.where(F.pmod(F.xxhash64("node", "tree", "leaf"), F.lit(1 << 30)) * F.col("n") < F.lit(SAMPLE << 30))
        planted = keep.put(_planted(sample, threshold, kind), f"planted{r}")
        routed = keep.put(_routed(todo.join(planted, KEY, "left"), threshold, kind), f"routed{r}")
        counted = routed.join(routed.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")), KEY)
        open_ = (F.col("n") > GROUP) & ~F.col("whole")
        closed = counted.where(~open_).select(*KEY, "node", "n", "whole")
        ends = closed if ends is None else ends.unionByName(closed)
        todo = counted.where(open_).drop("whole").join(vectors, "node")
        if not counted.where(open_).limit(1).count():
            break
    return done.unionByName(ends.join(vectors, "node").select(*done.columns))


def _blocks(rows: DataFrame, whole) -> DataFrame:
    """Rows with lo, hi and block: groups of over GROUP rows that are compared in whole come as pairs of blocks."""
    many = F.when(whole, F.ceil(F.col("n") / GROUP)).otherwise(F.lit(1)).cast("int")
    dealt = rows.withColumn("blocks", many).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("block", j).alias("lo"), F.greatest("block", j).alias("hi")))
    return dealt.withColumn("pair", F.explode(pairs)).select("*", "pair.lo", "pair.hi").drop("pair", "blocks", "n")


def _near(x: np.ndarray, threshold: float, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of left and right that are near, in parts."""
    for lo in range(0, len(left), 512):
        i, j = np.nonzero(x[left[lo : lo + 512]] @ x[right].T >= threshold)
        yield left[lo + i], right[j]


def _forests(groups: DataFrame, threshold: float, trees: int, kind: str) -> DataFrame:
    """a, b: a spanning forest of the links that each task finds."""

    def run(table: pa.Table) -> pa.Table:
        x, node, block = _unit(table.column("vec").to_pylist(), kind), table.column("node").to_numpy(), table.column("block").to_numpy()
        tree, lo, hi, whole = (table.column(c)[0].as_py() for c in ("tree", "lo", "hi", "whole"))
        root = np.arange(len(x))
        if whole:
            parts = iter([(np.flatnonzero(block == lo), np.flatnonzero(block == hi))])
        else:
            parts = ((own, own) for t in (range(trees) if tree is None else [tree]) for own in leaves(x, _margin(x.shape[1], threshold), t))
        for left, right in parts:
            for a, b in _near(x, threshold, left, right):
                root = forest(len(x), np.r_[np.arange(len(x)), a], np.r_[root, b])
        other = np.flatnonzero(root != np.arange(len(x)))
        return pa.table({"a": node[root[other]], "b": node[other]})

    return groups.groupBy(*KEY, "lo", "hi").applyInArrow(run, "a long, b long")


def _counts(groups: DataFrame, threshold: float, kind: str) -> DataFrame:
    """node, n: how many rows of other nodes each node links with, in each pair of blocks of its component."""

    def run(table: pa.Table) -> pa.Table:
        x, node, block, copies = _unit(table.column("vec").to_pylist(), kind), table.column("node").to_numpy(), table.column("block").to_numpy(), table.column("copies").to_numpy()
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        n = np.zeros(len(x), np.int64)
        for a, b in _near(x, threshold, left, right):
            other = a != b
            n += np.bincount(a[other], copies[b[other]], len(x)).astype(np.int64)
            if lo != hi:
                n += np.bincount(b[other], copies[a[other]], len(x)).astype(np.int64)
        return pa.table({"node": node, "n": n}).filter(pa.array(n > 0))

    return groups.groupBy("root", "lo", "hi").applyInArrow(run, "node long, n long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, trees: int = TREES, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    keep = Scratch(vectors.sparkSession, "neighbours")
    kind = "<f4" if dict(vectors.dtypes)[vec_col] == "array<float>" else "<f8"
    rows = keep.put(_read(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).alias("vec")), kind), "rows")
    nodes = rows.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vec").alias("vec"))
    nodes = keep.put(nodes.withColumn("node", F.monotonically_increasing_id()).withColumn("dim", (F.octet_length("vec") / np.dtype(kind).itemsize).cast("int")), "nodes")
    links = keep.put(_forests(_blocks(_split(nodes, threshold, trees, keep, kind), F.col("whole")), threshold, trees, kind), "links")
    roots = keep.put(components(links, keep), "roots")
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    members = nodes.select("node", "copies", "vec").join(roots, "node").join(sizes, "root")
    counts = _counts(_blocks(members, F.lit(True)), threshold, kind).groupBy("node").agg(F.sum("n").alias("others"))
    named = nodes.select("key", "node", "least", "copies").join(counts, "node", "left").join(roots, "node", "left")
    named = keep.put(named.withColumn("root", F.coalesce("root", "node")), "named")
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    per_key = named.join(least, "root").select("key", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"), "component")
    out = rows.select("vec_id", "key").join(per_key, "key", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


#: DuckDB SQL for the rows of near_duplicates(), by all pairs.
SQL = """
with recursive v as (
    select vec_id, label, embedding::double[] as e from embeddings
    where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links as materialized (
    select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
    where list_cosine_similarity(a.e, b.e) >= 0.93
),
reach as (select vec_id as a, vec_id as b from v union select r.a, l.b from reach r join links l on l.a = r.b)
select d.vec_id, (select count(*) from links l where l.a = d.vec_id) as n_links, coalesce(m.least, d.vec_id) as component_id,
    coalesce(m.least, d.vec_id) = d.vec_id as kept
from embeddings d left join (select a, min(b) as least from reach group by 1) m on m.a = d.vec_id
"""
