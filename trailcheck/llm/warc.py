"""WARC records in a content-addressed archive (operator 5).

The archive is two tables of files in the shared folder.  ``payloads`` holds the bytes of each distinct payload once,
under its SHA-256; grouping compares the bytes themselves, and copies collapse in each task before the shuffle.
``headers`` holds the exact header block of every record apart from its content.  A record is its header block, a
blank line, its payload and two line ends, and is put together again by joining the two on the digest; a reader
recomputes both digests of every payload and fails on a difference.

Of records with equal payloads the one with the largest id is a response, the others are revisits of it; payloads
under ``min_bytes`` are always responses.

Defined cases: a null payload counts as empty; a null address leaves the field out; control characters and spaces
in an address are percent-encoded, so a header cannot be broken; rows that share the id of the response are all
responses; a null id is smaller than any other; very long payloads are whole; an empty table gives empty archives;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailcheck.llm.common import shared_dir, stored

URN = "urn:trailcheck:page:"
#: Fixed value: the WARC profile of a revisit with an identical payload digest.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Archive:
    headers: DataFrame
    payloads: DataFrame


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 40 hex digits are eight groups of four base-32 digits."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _address(url: Column) -> Column:
    """The address without characters that would break a header line."""
    for code in [*range(0x21), 0x7F]:
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_archive(df: DataFrame, id_col: str, url_col: str, payload_col: str, date: str = "1970-01-01T00:00:00Z", min_bytes: int = 0) -> Archive:
    """Write both tables; returns them as read back.  ``date`` is the capture time of the records."""
    at = shared_dir(df.sparkSession, "warc")
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    once = rows.groupBy("payload").agg(F.max("id").alias("response_id"))
    content = F.col("payload").cast("binary")
    payloads = stored(once.select(F.sha2(content, 256).alias("sha256"), base32_sha1(content).alias("sha1"), F.octet_length("payload").cast("long").alias("n_bytes"),
                                  "response_id", content.alias("payload")), "payloads", at)
    classes = payloads.select("sha256", "sha1", "n_bytes", "response_id")
    met = rows.select("id", "url", F.sha2(F.col("payload").cast("binary"), 256).alias("sha256")).join(classes, "sha256")
    revisit = (F.col("n_bytes") >= min_bytes) & ~F.col("id").eqNullSafe(F.col("response_id"))
    urn = lambda c: F.concat(F.lit(f"<{URN}"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), _line("WARC-Record-ID", urn(F.col("id"))),
        _line("WARC-Target-URI", _address(F.col("url"))), _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))), _line("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, urn(F.col("response_id")))), _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n_bytes").cast("string"))))
    headers = stored(met.select("sha256", header.cast("binary").alias("header")), "headers", at)
    return Archive(headers, payloads.drop("response_id"))


def _field(name: str) -> Column:
    value = F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def _id(name: str) -> Column:
    return F.regexp_extract(_field(name), rf"^<{URN}(-?[0-9]+)>$", 1)


def verified(payloads: DataFrame) -> DataFrame:
    """The payload table; reading a row whose bytes do not match its digests fails."""
    same = (F.sha2("payload", 256) == F.col("sha256")) & (base32_sha1(F.col("payload")) == F.col("sha1")) & (F.octet_length("payload") == F.col("n_bytes"))
    return payloads.withColumn("sha256", F.when(same, F.col("sha256")).otherwise(F.raise_error(F.lit("payload does not match its digest"))))


def reconstruct(archive: Archive) -> DataFrame:
    """(id, record): the full bytes of every record; a revisit has an empty block."""
    blank = F.lit("\r\n").cast("binary")
    id_ = _id("WARC-Record-ID")
    heads = archive.headers.select(F.when(id_ != "", id_.cast("long")).alias("id"), "sha256", "header", _field("WARC-Type").alias("kind"))
    full = heads.where("kind = 'response'").join(verified(archive.payloads).select("sha256", "payload"), "sha256")
    return full.select("id", F.concat("header", blank, "payload", blank, blank).alias("record")).unionByName(
        heads.where("kind != 'response'").select("id", F.concat("header", blank, blank, blank).alias("record")))


def read_archive(archive: Archive) -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to) from the header blocks and the verified payloads."""
    checked = verified(archive.payloads).select("sha256", "sha1", "n_bytes")
    own, other = _id("WARC-Record-ID"), _id("WARC-Refers-To")
    heads = archive.headers.select("sha256", F.when(own != "", own.cast("long")).alias("id"), F.regexp_extract(_field("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("digest"),
                                   _field("WARC-Type").alias("record_type"), F.when(other != "", other.cast("long")).alias("refers_to"))
    digest = F.when(F.col("digest") == F.col("sha1"), F.col("digest")).otherwise(F.raise_error(F.lit("header and payload digests differ")))
    return heads.join(checked, "sha256").select("id", F.col("n_bytes").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to")


def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return read_archive(write_archive(pages, "page_id", "url", "html")).withColumnRenamed("id", "page_id")
