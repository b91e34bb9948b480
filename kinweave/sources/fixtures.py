"""Business directories and noisy documents derived from the driver's tables, to run every operator on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, business_name, business_address, country, owner_k, source of S1, S2 and S3; owner_k is the truth."""
    c, n, p = (table(spark, sf_dir, x) for x in ("customer", "nation", "part"))
    base = c.join(n, c.c_nationkey == n.n_nationkey).join(p, p.p_partkey == c.c_custkey * 7 % 200).select(c.c_custkey.alias("k"), n.n_name.alias("nat"), p.p_name.alias("pn"), p.p_brand.alias("pb"))
    k, text = F.col("k"), F.col("k").cast("string")
    cols = lambda i, name, address, owner, source: [i.alias("entity_id"), name.alias("business_name"), address.alias("business_address"), F.col("nat").alias("country"), owner.alias("owner_k"), F.lit(source).alias("source")]
    pin = (k + 10000).cast("string")
    s1 = base.select(*cols(F.concat(F.lit("S1-"), text), F.concat("pn", F.lit(" "), "pb", F.lit(" Pvt. Ltd.")), F.concat(F.lit("No-00"), text, F.lit(" Main Rd, "), "nat", F.lit(" "), pin), k, "S1"))
    s2 = base.where(k % 3 != 0).select(*cols(F.concat(F.lit("S2-"), text), F.upper(F.concat("pn", F.lit(" & "), "pb")), F.when(k % 11 != 0, F.concat(text, F.lit(" main road "), pin)), k, "S2"))
    s3 = base.where(k % 2 == 0).select(*cols(F.concat(F.lit("S3-"), text), F.concat("pb", F.lit(" "), "pn", F.lit(" Private Limited")), F.concat(F.lit("Main Ave "), "nat"), F.when(k % 4 == 0, F.lit(-1)).otherwise(k), "S3"))
    return s1.unionByName(s2).unionByName(s3)


def noisy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records: the first six words are the name, the next nineteen the address, the language the country."""
    words = F.filter(F.split(F.lower("text"), r"\s+"), lambda x: x != "")
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", words.alias("w"))
    return d.select(F.col("doc_id").cast("string").alias("entity_id"), F.array_join(F.slice("w", 1, 6), " ").alias("business_name"), F.array_join(F.slice("w", 7, 19), " ").alias("business_address"), F.col("lang").alias("country"), F.when(F.col("doc_id") % 3 == 0, "S1").otherwise("S2").alias("source"))
