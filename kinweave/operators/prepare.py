"""Clean columns, skeletons and the split of records into the reference table and its targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.functions import text

CLEAN = ("name_clean", "address_clean")


def add_clean_columns(df: DataFrame, name: str = "business_name", address: str = "business_address", ascii_input: bool = False) -> DataFrame:
    return df.withColumns({"name_clean": text.normalize_name(F.col(name), ascii_input), "address_clean": text.normalize_address(F.col(address), ascii_input)})


def ensure_clean_columns(df: DataFrame, **kw) -> DataFrame:
    return df if set(CLEAN) <= set(df.columns) else add_clean_columns(df, **kw)


def add_skeleton(df: DataFrame) -> DataFrame:
    return df.withColumn("name_skeleton", text.skeleton(F.col("name_clean")))


def load_split(records: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """The reference table and the targets (with their source), clean and with skeletons."""
    ready = ensure_clean_columns(records, **kw)
    ready = ready if "name_skeleton" in ready.columns else add_skeleton(ready)
    return ready.where("source = 'S1'"), ready.where("source <> 'S1'")
