"""What the operators share: reading tables, shared scratch tables, digests, prefix sums.

Column functions take null for empty text. gapless() keeps null keys as a key of their own and breaks ties by the order given;
columns whose names begin with two underscores are its own. Empty tables give empty tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

#: A word of every operator here: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a new one only where that is unset and the session local."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir")
    if not at:
        at = sc.getCheckpointDir()
        if not at:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="kinweave-"))
            at = sc.getCheckpointDir()
    return at.rstrip("/")


class Scratch:
    """Tables written to the shared folder and read back, so that later steps neither recompute nor depend on executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/kinweave/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        df.write.mode("overwrite").option("compression", compression).parquet(self.path(name))
        return self.get(name, df.schema)

    def get(self, name: str, schema=None) -> DataFrame:
        reader = self.spark.read
        return (reader.schema(schema) if schema is not None else reader).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)


def utf8(text: Column) -> Column:
    """UTF-8 bytes; null counts as empty."""
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: each 40 bits are 10 hex digits and 8 base32 digits."""
    digest = F.sha1(data)
    digits = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def gapless(df: DataFrame, keys: list[str], order: list[Column], name: str, spread: Column, chunks: int) -> DataFrame:
    """Number the rows of each key from 0 without gaps, in chunks so that no task sorts a whole key.

    spread: deals a key's rows to `chunks` chunks; the chunks' counts are summed up once (at most keys x chunks rows)."""
    part = df.withColumn("__chunk", F.pmod(spread, F.lit(chunks)).cast("int"))
    counts = part.groupBy(*keys, "__chunk").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "__chunk", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__from"))
    inside = Window.partitionBy(*keys, "__chunk").orderBy(*order)
    numbered = part.withColumn("__at", F.row_number().over(inside) - 1)
    same = [numbered[k].eqNullSafe(starts[k]) for k in [*keys, "__chunk"]]
    cond = same[0]
    for x in same[1:]:
        cond = cond & x
    return numbered.join(starts, cond, "inner").select(*[numbered[c] for c in df.columns], (numbered["__at"] + starts["__from"]).alias(name))


SIEVE = 1 << 22


def sieve(codes: DataFrame) -> DataFrame:
    """A bitmap of the codes (the first column) as at most SIEVE / 64 rows, small enough to broadcast whatever the input."""
    at = codes.select(F.pmod(F.xxhash64(codes.columns[0]), F.lit(SIEVE)).alias("b"))
    return at.select((F.col("b") / 64).cast("int").alias("__word"), F.expr("shiftleft(1L, cast(b % 64 as int))").alias("bit")).groupBy("__word").agg(F.bit_or("bit").alias("__bits"))


def sift(df: DataFrame, code: str, bitmap: DataFrame, name: str) -> DataFrame:
    """df with a boolean column: false only where the code isn't among the bitmap's. Spares the others a shuffle."""
    b = F.pmod(F.xxhash64(code), F.lit(SIEVE))
    marked = df.withColumn("__at", (b / 64).cast("int")).join(F.broadcast(bitmap), F.col("__at") == F.col("__word"), "left")
    hit = F.shiftright(F.coalesce(F.col("__bits"), F.lit(0).cast("long")), 0).bitwiseAND(F.expr(f"shiftleft(1L, cast(pmod(xxhash64({code}), {SIEVE}) % 64 as int))")) != 0
    return marked.select(*df.columns, hit.alias(name))
