"""Connected components of a table of links, on the executors alone.

Links are first thinned inside each task by union-find, then large-star and small-star steps (Kiveris et al., 2014)
alternate until nothing changes; each step's links are a table in the shared folder. Links with a null end are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import Scratch

MOST_STEPS = 60


class Union:
    """Union-find by smallest member over any orderable ids."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        up = self.up
        root = x
        while (p := up.setdefault(root, root)) != root:
            root = p
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if a > b:
            a, b = b, a
        self.up[b] = a
        return True


def thin(links: DataFrame) -> DataFrame:
    """Links a < b (long) that join what each task's links join, at most one a member."""

    def run(batches):
        union = Union()
        for b in batches:
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if x is not None and y is not None and x != y:
                    union.join(x, y)
        pairs = [(union.find(x), x) for x in union.up]
        pairs = np.array([p for p in pairs if p[0] != p[1]], "i8").reshape(-1, 2)
        for i in range(0, len(pairs), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[i : i + 50_000, 0]), pa.array(pairs[i : i + 50_000, 1])], ["a", "b"])

    a, b = links.columns[:2]
    return links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).mapInArrow(run, "a long, b long")


def components(links: DataFrame, keep: Scratch, name: str = "links") -> DataFrame:
    """node, root: each linked node and the smallest node that it reaches. links: two long columns."""
    now = keep.put(thin(links).distinct(), f"{name}0")
    mark = None
    for k in range(1, MOST_STEPS):
        # large-star: a node's larger neighbours go to its smallest one
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        # small-star: a node's smaller neighbours and itself go to its smallest one
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("m").alias("a"), F.explode(F.array(F.col("a"), F.col("b"))).alias("b")).where("a < b").distinct()
        now = keep.put(small, f"{name}{k}")
        last, mark = mark, tuple(now.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())
        keep.drop(f"{name}{k - 1}")
        if mark == last or not mark[0]:
            break
    else:
        raise RuntimeError("components don't settle")
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
