"""A content-addressed WARC archive.

`write` stores each distinct payload once, under its SHA-256, beside its length and SHA-1, and each record's exact header
block in a second table with the payload's key. `read` reconstructs every record's bytes by joining the two tables,
parses the header block again and verifies length and both digests against the payload it got. Both tables are
partitioned by the leading digest bits, so archives grow by files and not by file size.

Of the records with equal payloads of at least `min_bytes` bytes the one with the smallest id is a response and the others
are revisits that refer to it (by id in WARC-Refers-To); smaller payloads are all responses. A null or empty payload is
empty. Rows with equal ids and payloads are one response and revisits to it, in row order. A null id is written as such and
sorts after all others. An empty table gives empty tables. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kinweave.llm.common import Scratch, base32_sha1, utf8

CRLF = "\r\n"
#: Every record carries one date, so that writing the same pages again gives the same bytes.
DATE = "2024-01-01T00:00:00Z"
URN = "urn:kinweave:page:"


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def _urn(page: Column) -> Column:
    return F.concat(F.lit(f"<{URN}"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def header_block(kind: Column, page: Column, url: Column, digest: Column, length: Column, refers: Column) -> Column:
    """The record's header lines and the blank line after them. A revisit's own block is empty; its payload's length is
    in a header of its own, since its Content-Length is 0."""
    revisit = kind == "revisit"
    clean = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", "")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", _urn(page)),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", clean),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.when(revisit, F.concat(_line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), _line("WARC-Refers-To", _urn(refers)), _line("WARC-Refers-To-Payload-Length", length.cast("string")))).otherwise(F.lit("")),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(length.cast("string"))),
        F.lit(CRLF),
    )


def write(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> None:
    """The tables `payloads` and `headers` under path. The payload bytes are shuffled once, to their digest's place."""
    spark = pages.sparkSession
    keep = Scratch(spark, "warc")
    data = utf8(F.col(html_col))
    seen = keep.put(
        pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url") if url_col in pages.columns else F.lit("").alias("url"), F.octet_length(data).cast("long").alias("payload_bytes"), base32_sha1(data).alias("payload_digest"), F.unhex(F.sha2(data, 256)).alias("key")).withColumn("row", F.monotonically_increasing_id()),
        "seen",
    )
    first = F.struct(F.col("page_id").isNull(), "page_id", "row")
    firsts = seen.groupBy("key").agg(F.min(first).alias("first"))
    joined = seen.join(firsts, "key")
    revisit = (F.col("payload_bytes") >= min_bytes) & (F.col("row") != F.col("first.row"))
    heads = joined.select("key", "row", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("kind"), "page_id", "url", "payload_digest", "payload_bytes", F.col("first.page_id").alias("refers"))
    heads.select("key", "row", header_block(F.col("kind"), F.col("page_id"), F.col("url"), F.col("payload_digest"), F.col("payload_bytes"), F.col("refers")).cast("binary").alias("head"), F.col("page_id").alias("record")).write.mode("overwrite").parquet(f"{path}/headers")
    # equal keys with unequal bytes would show here as two lengths or two SHA-1 digests; that is an error, never a merge
    clash = seen.groupBy("key").agg(F.min("payload_digest").alias("a"), F.max("payload_digest").alias("b"), F.min("payload_bytes").alias("c"), F.max("payload_bytes").alias("d")).where("a <> b or c <> d")
    if clash.limit(1).count():
        raise ValueError("two payloads share a SHA-256 digest")
    bodies = pages.select(F.unhex(F.sha2(data, 256)).alias("key"), data.alias("payload"))
    bodies.groupBy("key").agg(F.first("payload").alias("payload")).write.mode("overwrite").parquet(f"{path}/payloads")
    keep.drop("seen")


def read(spark, path: str) -> DataFrame:
    """row, record (id), head, payload, record_bytes: the records as they were, from the two tables."""
    heads, bodies = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    own = F.when(F.col("head").cast("string").startswith(F.lit(f"WARC/1.1{CRLF}WARC-Type: revisit")), F.lit(b"")).otherwise(F.col("payload"))
    return heads.join(bodies, "key", "left").withColumn("record_bytes", F.concat(F.col("head"), own, F.lit(f"{CRLF}{CRLF}".encode())))


def field(head: Column, name: str) -> Column:
    """A header's value, or null."""
    return F.nullif(F.regexp_extract(head, rf"(?:^|\r\n){name}: ([^\r\n]*)\r\n", 1), F.lit(""))


def records(archive: DataFrame) -> DataFrame:
    """One row per record, parsed from the header block and checked against the payload that the join brought.

    A record whose payload is missing or doesn't match its digest or length is an error, not a row."""
    head = F.col("head").cast("string")
    size, digest = F.octet_length("payload").cast("long"), base32_sha1(F.col("payload"))
    told = F.coalesce(field(head, "WARC-Refers-To-Payload-Length"), field(head, "Content-Length")).cast("long")
    sound = F.col("payload").isNotNull() & (told == size) & (field(head, "WARC-Payload-Digest") == F.concat(F.lit("sha1:"), digest)) & (F.unhex(F.sha2("payload", 256)) == F.col("key"))
    page = lambda name: F.expr(f"try_cast(nullif(regexp_extract({name}, '<{URN}(.*)>', 1), '') as bigint)")
    return (
        archive.select(
            field(head, "WARC-Record-ID").alias("rid"), field(head, "WARC-Refers-To").alias("rto"), field(head, "WARC-Type").alias("record_type"), field(head, "WARC-Target-URI").alias("url"),
            F.when(F.coalesce(sound, F.lit(False)), size).otherwise(F.raise_error(F.lit("a record doesn't match its payload")).cast("long")).alias("payload_bytes"), digest.alias("payload_digest"),
        )
        .select(page("rid").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("rto").alias("refers_to"), "url")
    )


#: DuckDB SQL for the rows of records(), without url. Four groups of 40 bits of the SHA-1 give eight base32 digits each.
SQL = """
with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
q as (
    select page_id, octet_length(payload) as payload_bytes, sha1(payload) as h,
        row_number() over (partition by payload order by page_id nulls last) as place,
        first_value(page_id) over (partition by payload order by page_id nulls last) as smallest
    from p
)
select page_id, payload_bytes::bigint as payload_bytes,
    array_to_string([
        array_to_string([
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, 1 + 10 * i, 10))::bigint >> (35 - 5 * j)) & 31)::int + 1, 1)
            for j in range(8)], '')
        for i in range(4)], '') as payload_digest,
    case when place = 1 then 'response' else 'revisit' end as record_type,
    case when place > 1 then smallest end as refers_to
from q
"""
