"""Content-addressed WARC archive.

Payload bytes are stored once per verified SHA-256 digest; the exact header
bytes of every record are kept apart from them, and original records are put
together again by a join on the digest.

Archive layout (two Parquet tables in one folder):

* ``payloads``: digest, payload, payload_bytes, owner (smallest record id with
  this payload), n_records;
* ``records``: digest, header (exact bytes up to and including the empty line),
  one row per record.

Edge cases: a null payload is an empty one; a record whose id is null is
always a response and never referred to; repeated rows are separate records
(rows that repeat the smallest id are all responses); control characters in a
URL are percent-encoded so that a header always parses; an empty table gives
an empty archive; other columns of the input are ignored.

A hot payload (a third of all rows) is combined to one row per map task before
the shuffle; the joins on the digest are plain equi-joins whose large side
adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import shared_path

REVISIT_MIN_BYTES = 100
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
RECORD_END = b"\r\n\r\n"


def _record(html: Column) -> list[Column]:
    payload = F.encode(F.coalesce(html, F.lit("")), "UTF-8")
    return [payload.alias("payload"), F.sha2(payload, 256).alias("digest"),
            F.octet_length(payload).cast("long").alias("payload_bytes")]


def payload_store(records: DataFrame) -> DataFrame:
    """One row per distinct payload. The digest is verified: rows that share
    it must agree in length and in an independent 64-bit hash."""
    check = F.struct("payload_bytes", F.xxhash64("payload"))
    groups = records.groupBy("digest").agg(
        F.first("payload").alias("payload"), F.first("payload_bytes").alias("payload_bytes"),
        F.min("id").alias("owner"), F.count(F.lit(1)).alias("n_records"),
        F.min(check).alias("lo"), F.max(check).alias("hi"))
    verified = F.when(F.col("lo") == F.col("hi"), F.col("digest")).otherwise(
        F.raise_error(F.concat(F.lit("payloads differ under digest "), F.col("digest"))))
    return groups.select(verified.alias("digest"), "payload", "payload_bytes", "owner", "n_records")


def _url(col: Column) -> Column:
    clean = F.coalesce(col, F.lit(""))
    for char, code in (("\r", "%0D"), ("\n", "%0A"), ("\x00", "%00")):
        clean = F.replace(clean, F.lit(char), F.lit(code))
    return clean


def record_headers(records: DataFrame, owners: DataFrame, date: str, min_bytes: int) -> DataFrame:
    """The header bytes of every record. A revisit refers to the owner of its
    payload and has an empty block."""
    joined = records.join(owners.select("digest", "owner"), "digest")
    revisit = F.coalesce((F.col("payload_bytes") >= min_bytes) & (F.col("id") > F.col("owner")),
                         F.lit(False))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        F.when(F.col("id").isNull(), F.lit("")).otherwise(
            line("WARC-Record-ID", F.concat(F.lit("<urn:record:"), F.col("id").cast("string"),
                                            F.lit(">")))),
        line("WARC-Target-URI", _url(F.col("url"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(
            line("WARC-Refers-To", F.concat(F.lit("<urn:record:"), F.col("owner").cast("string"),
                                            F.lit(">"))),
            line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length",
             F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
        F.lit(CRLF))
    return joined.select("digest", F.encode(header, "UTF-8").alias("header"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", date: str = "1970-01-01T00:00:00Z",
                  min_bytes: int = REVISIT_MIN_BYTES) -> None:
    """Write the two tables of the archive under ``path``."""
    spark = pages.sparkSession
    records = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                           *_record(F.col(payload_col)))
    payload_store(records).write.option("compression", "zstd").parquet(f"{path}/payloads")
    owners = spark.read.parquet(f"{path}/payloads")
    record_headers(records.drop("payload"), owners, date, min_bytes) \
        .write.option("compression", "zstd").parquet(f"{path}/records")


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """The original records: header, payload (a revisit's is that of the record
    it refers to) and ``record``, the exact WARC bytes of header and block."""
    records = spark.read.parquet(f"{path}/records")
    payloads = spark.read.parquet(f"{path}/payloads").select("digest", "payload")
    joined = records.join(payloads, "digest")
    # a header line of its own: a URL may end in the same words
    block = F.when(F.col("header").cast("string").contains(f"{CRLF}WARC-Type: revisit{CRLF}"),
                   F.lit(b"")).otherwise(F.col("payload"))
    return joined.select("header", "payload",
                         F.concat(F.col("header"), block, F.lit(RECORD_END)).alias("record"))


def parse_records(records: DataFrame) -> DataFrame:
    """Fields of reconstructed records. The digest is computed again from the
    payload; one that differs from the header's raises an error."""
    text = F.col("header").cast("string")
    field = lambda pattern: F.regexp_extract(text, rf"\r\n{pattern}\r\n", 1)
    number = lambda pattern: F.nullif(field(pattern), F.lit("")).cast("long")
    digest = F.sha2("payload", 256)
    return records.select(
        number("WARC-Record-ID: <urn:record:(-?[0-9]+)>").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(field("WARC-Payload-Digest: sha256:([0-9a-f]{64})") == digest, digest)
        .otherwise(F.raise_error(F.lit("a payload does not match its digest")))
        .alias("payload_digest"),
        field("WARC-Type: ([a-z]+)").alias("record_type"),
        number("WARC-Refers-To: <urn:record:(-?[0-9]+)>").alias("refers_to"),
        field("WARC-Target-URI: ([^\r\n]*)").alias("target_uri"),
        number("Content-Length: ([0-9]+)").alias("content_length"))


def op1_warc_archive(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` and read the archive back: one row per page."""
    path = shared_path(pages.sparkSession, "warc")
    write_archive(pages, path)
    return parse_records(reconstruct(pages.sparkSession, path))


ORACLE_SQL = f"""
WITH sized AS (
  SELECT page_id, url, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, ''))::BIGINT AS bytes FROM pages),
told AS (
  SELECT *, CASE WHEN bytes >= {REVISIT_MIN_BYTES} AND page_id > min(page_id) OVER (PARTITION BY digest)
    THEN min(page_id) OVER (PARTITION BY digest) END AS refers_to FROM sized)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to,
  coalesce(url, '') AS target_uri, CASE WHEN refers_to IS NULL THEN bytes ELSE 0 END AS content_length
FROM told
"""
