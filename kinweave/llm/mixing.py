"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

Each source s has a target of T words. Rates r of its documents stay nearest to 1 in relative entropy under the token
constraint sum(size x r) = T and 0 <= r <= cap: r = min(cap, exp(l x size / mean size)), where l maximises a concave dual in
one unknown a source. All sources' unknowns take Newton steps together, each step one grouped sum over the distinct sizes of
each source; a step that leaves the bracket known to hold the root is replaced by the bracket's middle, so it always
converges. The tilted rates are rounded into whole copies from 0 to cap by error diffusion: the documents of a source are
dealt to chunks of at most about CHUNK rows, and inside a chunk, largest first, each takes the number of copies that brings
the chunk's words nearest to its rates' words so far. So every source misses its target by a few words of its smallest
documents, unless the sizes allow no better.

A source's weight goes by its place in code-point order (null last). Its target is its share by weight of `share` times
all words, at most cap times its own words, the excess shared again by weight until no source is above.

Nulls: a null text has size 0, a null source is a source of its own, a null id stays null. Repeated rows are rows of their
own, counted together before they are dealt to chunks. A document without words takes none. An empty table gives no rows. Rounding goes by hashes of the rows, so reruns agree. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kinweave.llm.common import Scratch, n_words

CHUNK = 256
STEPS = 60
NEAR = 1e-9


def targets(sizes: DataFrame, weights: list[float], share: float, cap: float) -> DataFrame:
    """source, source_size, target from source, words. One level of words a unit of weight: sources that reach their limit
    at a lower level stop there. In order of that limit, the level follows from running sums."""
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    ranked = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, map(float, weights))), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int")))
    ranked = ranked.withColumn("limit", F.col("source_size") * F.lit(float(cap))).withColumn("ratio", F.col("limit") / F.col("w"))
    by_ratio, whole = Window.orderBy("ratio", F.col("source").isNull(), "source"), Window.partitionBy(F.lit(1))
    stopped = F.coalesce(F.sum("limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight = F.sum("w").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    all_words = F.sum("source_size").over(whole) * F.lit(float(share))
    level = ranked.withColumn("level", (all_words - stopped) / weight)
    # the first source whose limit isn't reached sets the level for it and all after it
    level = level.withColumn("open", F.col("level") < F.col("ratio"))
    at = F.min(F.when(F.col("open"), F.struct("ratio", "level"))).over(whole)["level"]
    return level.withColumn("at", at).select("source", "source_size", F.least("limit", F.coalesce(F.col("w") * F.col("at"), F.col("limit"))).alias("target"))


def tilts(histogram: DataFrame, aims: DataFrame, cap: float, keep: Scratch) -> DataFrame:
    """source, mean, tilt. histogram: source, size, n."""
    spark = histogram.sparkSession
    words = histogram.where("size > 0").groupBy("source").agg(F.sum(F.col("n")).alias("docs"))
    start = aims.join(words, aims["source"].eqNullSafe(words["source"]), "left").select(aims["source"], "source_size", "target", (F.col("source_size") / F.col("docs")).alias("mean"))
    saturated = F.col("target") >= F.col("source_size") * F.lit(float(cap)) * (1 - 1e-12)
    # a bracket: all rates are 0 far below and cap far above; the smallest size is a word
    far = F.col("mean") * F.lit(60.0)
    start = start.where("source_size > 0").select("source", "source_size", "target", "mean", F.when(saturated, far).otherwise(F.lit(0.0)).alias("tilt"), (-far).alias("low"), far.alias("high"), (saturated | (F.col("target") <= 0)).alias("done"))
    state = keep.put(start.coalesce(1), "tilt0")
    for k in range(1, STEPS + 1):
        x = F.col("size") / F.col("mean")
        rate = F.exp(F.least(F.col("tilt") * x, F.lit(50.0)))
        inside = rate < cap
        words_at = F.sum(F.col("n") * F.col("size") * F.least(rate, F.lit(float(cap))))
        slope = F.sum(F.when(inside, F.col("n") * F.col("size") * rate * x).otherwise(0.0))
        h = histogram.withColumnRenamed("source", "own")
        sums = h.join(F.broadcast(state), h["own"].eqNullSafe(state["source"])).groupBy("source", "source_size", "target", "mean", "tilt", "low", "high", "done").agg(words_at.alias("got"), slope.alias("slope"))
        over = F.col("got") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("tilt")), F.when(over, F.col("tilt")).otherwise(F.col("high"))
        met = F.col("done") | (F.abs(F.col("got") - F.col("target")) <= NEAR * F.col("target"))
        newton = F.col("tilt") + (F.col("target") - F.col("got")) / F.when(F.col("slope") > 0, F.col("slope"))
        step = F.when((newton > low) & (newton < high), newton).otherwise((low + high) / 2)
        state = keep.put(sums.select("source", "source_size", "target", "mean", F.when(met, F.col("tilt")).otherwise(step).alias("tilt"), low.alias("low"), high.alias("high"), met.alias("done")).coalesce(1), f"tilt{k}")
        keep.drop(f"tilt{k - 1}")
        if not state.where(~F.col("done")).limit(1).count():
            break
    return state.select("source", "mean", "tilt")


def diffuse(docs: DataFrame, cap: int) -> DataFrame:
    """total copies of each distinct row of source, chunk, doc_id, code, size, n (how often it stands), rate, inside its chunk.
    A chunk has about CHUNK distinct rows, however often they stand."""
    item = F.struct((-F.col("size")).alias("order"), F.xxhash64("code").alias("tie"), F.col("code"), F.col("doc_id"), F.col("size"), F.col("n"), F.col("rate"))
    lists = docs.groupBy("source", "chunk").agg(F.array_sort(F.collect_list(item)).alias("items"))
    empty = F.array().cast("array<long>")

    def place(acc, x):
        due = acc["due"] + x["size"] * x["rate"] * x["n"]
        most = x["n"] * F.lit(cap)
        copies = F.when(x["size"] > 0, F.greatest(F.lit(0), F.least(most, F.floor((due - acc["got"]) / x["size"] + 0.5)))).otherwise(F.lit(0)).cast("long")
        return F.struct(due.alias("due"), (acc["got"] + x["size"] * copies).alias("got"), F.concat(acc["copies"], F.array(copies)).alias("copies"))

    start = F.struct(F.lit(0.0).alias("due"), F.lit(0).cast("long").alias("got"), empty.alias("copies"))
    chosen = F.aggregate("items", start, place, lambda acc: acc["copies"])
    return lists.select("source", F.inline(F.zip_with("items", chosen, lambda x, c: F.struct(x["doc_id"].alias("doc_id"), x["code"].alias("code"), x["size"].alias("size"), x["n"].alias("n"), x["rate"].alias("rate"), c.alias("total")))))


def row_code(docs: DataFrame):
    """A 128-bit digest of all columns, maps too: rows with one code are taken for equal."""
    return F.unhex(F.md5(F.to_json(F.struct(*[F.col(c) for c in docs.columns]))))


def _chosen(docs: DataFrame, weights: list[float], share: float, cap: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, code, size, source_size, target, rate, n, total copies of every distinct row."""
    keep = Scratch(docs.sparkSession, "mixing")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), row_code(docs).alias("code"))
    rows = keep.put(rows.groupBy("code").agg(*[F.first(c).alias(c) for c in ("doc_id", "source", "size")], F.count(F.lit(1)).alias("n")), "rows")
    histogram = keep.put(rows.groupBy("source", "size").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct")), "histogram")
    totals = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("distinct").alias("docs"))
    aims = keep.put(targets(totals.drop("docs"), list(weights), share, cap), "targets")
    found = tilts(histogram.drop("distinct"), aims, cap, keep)
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    per_source = aims.join(found, same(aims, found), "left").join(totals, same(aims, totals), "left").select(aims["source"], aims["source_size"], "target", "mean", "tilt", F.ceil(totals["docs"] / CHUNK).alias("chunks"))
    per_source = keep.put(per_source.coalesce(1), "per_source")
    rate = F.coalesce(F.least(F.lit(float(cap)), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(50.0)))), F.lit(0.0))
    rated = rows.join(per_source.select(F.col("source").alias("own"), "mean", "tilt", "chunks"), F.col("own").eqNullSafe(rows["source"])).select("source", F.pmod(F.xxhash64("code", F.lit(1)), F.col("chunks")).alias("chunk"), "doc_id", "code", "size", "n", rate.alias("rate"))
    whole = diffuse(rated, cap)
    per_source = per_source.select(F.col("source").alias("own"), "source_size", "target")
    return whole.join(per_source, F.col("own").eqNullSafe(whole["source"])).select("doc_id", "code", "size", "source_size", "target", "rate", "n", "total")


def mix(docs: DataFrame, weights: list[float] = (5, 2, 1), share: float = 1.5, cap: int = 2, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, code (a digest of the row), size, source_size, target, rate, copies, taken of every row. Equal rows share their
    copies: each takes the same number of them, some one more."""
    found = _chosen(docs, weights, share, cap, id_col, text_col, source_col)
    each, more = F.floor(F.col("total") / F.col("n")), F.pmod(F.col("total"), F.col("n"))
    kinds = F.explode(F.array(F.struct((each + 1).alias("copies"), more.alias("times")), F.struct(each.alias("copies"), (F.col("n") - more).alias("times"))))
    dealt = found.withColumn("k", kinds).where("k.times > 0").withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("k.times"))))
    copies = F.col("k.copies").cast("int")
    return dealt.select("doc_id", "code", "size", "source_size", "target", "rate", copies.alias("copies"), (F.col("size") * copies).cast("long").alias("taken"))


def mixed(docs: DataFrame, weights: list[float] = (5, 2, 1), share: float = 1.5, cap: int = 2, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents, each as often as the mix takes it, all columns as they were."""
    taken = _chosen(docs, weights, share, cap, id_col, text_col, source_col).where("total > 0").select(F.col("code").alias("__own"), F.col("n").alias("__rows"), F.col("total").alias("__copies"))
    # one of the equal rows stands for all
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), row_code(docs).alias("code"))
    single = rows.join(taken, F.col("code") == F.col("__own"))
    once = single.where("__rows = 1").select("row", "__copies").unionByName(single.where("__rows > 1").groupBy("code").agg(F.first("row").alias("row"), F.first("__copies").alias("__copies")).select("row", "__copies"))
    return once.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select("row.*")
