"""Content-addressed WARC archive.  DataFrame operations only.

Payload bytes are stored once, under their SHA-256, in files bucketed by it;
record headers are stored separately and exactly; a record is a header joined
with its payload, and a reader that knows the number of buckets joins without
moving the payloads again.  Of
records with equal payloads the one with the smallest page identifier is a
``response``, the others are ``revisit`` records that name it.  Reading
verifies every payload against its digests and every header against its
payload.

Defined results: a null payload is empty; payloads below ``min_bytes`` are
always responses; a null url gives an empty target; of rows with the same
smallest identifier and equal payloads one, by (url, row), is the response
(rows with a null identifier come last); rows that share an identifier have
records with different WARC-Record-IDs, since those also carry a row number of
the archive; an empty table gives an empty archive.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import col, shuffle_partitions, staged, table
from revlens.session import scratch_path

MIN_BYTES = 0
CRLF = "\r\n"
PAYLOADS = "sha256 string, sha1 string, body binary"
VERSION = "WARC/1.1"
# fixed values: RFC 4648 base32 digits, and the digits conv() writes in base 32
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
WARC_DATE = "1970-01-01T00:00:00Z"  # pages carry no capture time


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: 40 bits (10 hex digits) at a time."""
    hexed = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), CONV32, BASE32)


def record_id(page: Column, row: Column) -> Column:
    """Page identifier and row number in the archive: unique also where pages share an identifier."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(":"), row.cast("string"), F.lit(">"))


def catalog_name() -> str:
    """A name for the moments in which Spark's catalog knows the bucketed files."""
    return f"revlens_payloads_{uuid.uuid4().hex}"


def header(fields: list[tuple[str, Column]]) -> Column:
    """Version line and the named fields that are not null, ended by an empty line."""
    lines = [F.concat(F.lit(name + ": "), value) for name, value in fields]
    return F.concat(F.concat_ws(CRLF, F.lit(VERSION), *lines), F.lit(CRLF + CRLF))


def write(pages: DataFrame, path: str, ident: str = "page_id", url: str = "url", payload: str = "html",
          min_bytes: int = MIN_BYTES, buckets: int | None = None) -> int:
    """Write ``path/payloads`` (sha256, sha1, bytes: one row per distinct payload)
    and ``path/headers`` (page, sha256, header text: one row per record).  Returns
    the number of buckets of the payloads (default: the shuffle partitions)."""
    spark = pages.sparkSession
    buckets = buckets or shuffle_partitions(spark)
    rows = pages.select(col(ident).alias("page"), F.coalesce(col(url), F.lit("")).alias("url"),
                        F.coalesce(col(payload), F.lit("")).cast("binary").alias("body"))
    rows = rows.select("page", "url", F.sha2("body", 256).alias("sha256"), "body")
    # short rows decide who is the response; the bodies of copies are dropped before the shuffle where tasks meet them
    # row numbers are given once, in the written table, so that every reader sees the same ones
    slim = staged(rows.select("page", "url", "sha256", base32_sha1(F.col("body")).alias("sha1"),
                              F.octet_length("body").cast("long").alias("n"), F.monotonically_increasing_id().alias("row")), "warc-records")
    order = F.struct(F.col("page").isNull().alias("unnamed"), "page", "url", "row")
    firsts = staged(slim.groupBy("sha256").agg(F.min(order).alias("first")), "warc-firsts")
    marked = slim.join(firsts, "sha256")
    response = (F.col("n") < min_bytes) | (F.col("row") == F.col("first.row"))
    revisit = ~response
    text = header([
        ("WARC-Type", F.when(response, "response").otherwise("revisit")),
        ("WARC-Record-ID", record_id(F.col("page"), F.col("row"))),
        ("WARC-Date", F.lit(WARC_DATE)),
        ("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", "")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        ("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        ("WARC-Refers-To", F.when(revisit, record_id(F.col("first.page"), F.col("first.row")))),
        ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("Content-Length", F.when(response, F.col("n")).otherwise(0).cast("string")),
    ])
    marked.select("page", "sha256", text.alias("header")).write.parquet(f"{path}/headers")
    name = catalog_name()
    rows.groupBy("sha256").agg(F.first("body").alias("body")) \
        .select("sha256", base32_sha1(F.col("body")).alias("sha1"), "body") \
        .write.format("parquet").bucketBy(buckets, "sha256").option("path", f"{path}/payloads").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay: the archive is its folder
    return buckets


def field(name: str) -> Column:
    """The value of a named field of the column ``header``."""
    found = F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(found != "", found)


def payloads(spark: SparkSession, path: str, buckets: int | None = None) -> DataFrame:
    """sha256 and body of the stored payloads; a body that doesn't give its digests fails the read."""
    if buckets:
        name = catalog_name()
        spark.sql(f"CREATE TABLE {name} ({PAYLOADS}) USING parquet CLUSTERED BY (sha256) INTO {buckets} BUCKETS LOCATION '{path}/payloads'")
        rows = spark.table(name)
        spark.sql(f"DROP TABLE {name}")
    else:
        rows = spark.read.schema(PAYLOADS).parquet(f"{path}/payloads")
    good = (F.sha2("body", 256) == F.col("sha256")) & (base32_sha1(F.col("body")) == F.col("sha1"))
    wrong = F.raise_error(F.concat(F.lit("payload does not match its digest: "), F.col("sha256"))).cast("binary")
    return rows.select("sha256", F.when(good, F.col("body")).otherwise(wrong).alias("body"))


def headers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("page long, sha256 string, header string").parquet(f"{path}/headers")


def records(spark: SparkSession, path: str, expand_revisits: bool = False, buckets: int | None = None) -> DataFrame:
    """page and the bytes of every record as a WARC file holds them: header,
    block, two line ends.  With ``expand_revisits`` revisits carry their payload too.
    A record whose payload is needed and not in the archive fails the read.

    Only records with a block meet the payloads.  Without ``expand_revisits``
    that is about one record a payload, so ``buckets`` (what ``write`` returned)
    may spare the payloads' shuffle; the many revisits of one payload are left to
    Spark's skew join, which needs the shuffle."""
    rows = headers(spark, path)
    lost = F.raise_error(F.concat(F.lit("record without its payload: "), F.col("sha256"))).cast("binary")

    def whole(block: Column) -> Column:
        return F.concat(F.encode("header", "UTF-8"), block, F.lit(b"\r\n\r\n")).alias("record")

    if expand_revisits:
        return rows.join(payloads(spark, path), "sha256", "left").select("page", whole(F.coalesce(F.col("body"), lost)))
    kind = field("WARC-Type")
    filled = rows.filter(kind == "response").join(payloads(spark, path, buckets), "sha256", "left")
    return filled.select("page", whole(F.coalesce(F.col("body"), lost))) \
        .unionByName(rows.filter(kind == "revisit").select("page", whole(F.lit(b""))))


def parsed(rebuilt: DataFrame) -> DataFrame:
    """header (text, with its last line end) and block (bytes) of the column ``record``."""
    head = F.substring_index(F.col("record").cast("string"), CRLF + CRLF, 1)
    cut = rebuilt.withColumn("header", F.concat(head, F.lit(CRLF)))
    begin = F.octet_length("header") + len(CRLF) + 1
    size = F.octet_length("record") - F.octet_length("header") - 3 * len(CRLF)
    return cut.select("header", F.substring("record", begin, size).alias("block"))


def index(spark: SparkSession, path: str, buckets: int | None = None) -> DataFrame:
    """One row per record, read from the rebuilt records: page, payload_bytes,
    payload_digest, record_type, refers_to.  A revisit's payload is that of the
    record it names, whose digest must be its own."""
    rows = staged(parsed(records(spark, path, buckets=buckets)).select(
        field("WARC-Record-ID").alias("id"), field("WARC-Type").alias("record_type"), field("WARC-Refers-To").alias("to"),
        F.regexp_extract(field("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("digest"),
        field("Content-Length").cast("long").alias("length"), F.octet_length("block").cast("long").alias("n"),
        base32_sha1(F.col("block")).alias("sha1")), "warc-read")
    responses = rows.filter("record_type = 'response'")
    named = responses.select(F.col("id").alias("to"), F.col("n").alias("named_n"), F.col("digest").alias("named_digest"))
    revisits = rows.filter("record_type = 'revisit'").join(named, "to", "left")

    def report(df: DataFrame, good: Column, n: Column) -> DataFrame:
        page = lambda name: F.expr(f"try_cast(regexp_extract({name}, '^<urn:page:(-?[0-9]+):', 1) AS long)")
        wrong = F.raise_error(F.concat(F.lit("record does not match its payload: "), F.col("id"))).cast("long")
        return df.select(page("id").alias("page"), F.when(good & (F.col("length") == F.col("n")), n).otherwise(wrong).alias("payload_bytes"),
                         F.col("digest").alias("payload_digest"), "record_type", page("to").alias("refers_to"))

    return report(responses, F.col("sha1") == F.col("digest"), F.col("n")) \
        .unionByName(report(revisits, F.col("named_digest") == F.col("digest"), F.col("named_n")))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page, rebuild every record and report what the records say."""
    path = scratch_path(spark, "warc")
    buckets = write(table(spark, sf_dir, "pages"), path)
    return index(spark, path, buckets).withColumnRenamed("page", "page_id")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s FROM pages),
f AS (SELECT page_id, h, s, min(page_id) OVER (PARTITION BY h) AS first,
             row_number() OVER (PARTITION BY h ORDER BY page_id NULLS LAST) AS k FROM p)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           (CAST('0x' || substr(s, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS INTEGER), 1)
           FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k > 1 THEN first END AS refers_to
FROM f
"""
