"""A content-addressed web archive: each payload is stored once, each record header exactly.

An archive is two tables in one folder: ``headers`` (one row per record: its id and the exact
bytes of its WARC header block) and ``payloads`` (one row per distinct payload, addressed by
SHA-256). Records are restored by joining the two on the address, which the header carries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# RFC 4648 base32 letters and the WARC 1.1 names.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

WARC_DATE = "2024-01-01T00:00:00Z"
_ID = "<urn:farewind:page:"


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a hexadecimal digest of 160 bits: 5 digits are 20 bits are 4 letters."""
    letters = []
    for start in range(0, 40, 5):
        bits = F.conv(F.substring(digest, start + 1, 5), 16, 10).cast("int")
        letters += [
            F.substring(F.lit(BASE32), F.shiftright(bits, 15 - 5 * k).bitwiseAND(31) + 1, F.lit(1))
            for k in range(4)
        ]
    return F.concat(*letters)


def _header(kind: Column, refers_to: Column) -> Column:
    """The header block with its blank line; lines end in CR LF."""
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit(f"WARC-Record-ID: {_ID}"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">")),
        F.lit(f"WARC-Date: {WARC_DATE}"),
        # a line break in an address would start another header
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.col("url"), r"[\r\n]+", "%0A")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("WARC-Block-Digest: sha256:"), F.col("address")),
        F.when(kind == "revisit", F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.concat(F.lit(f"WARC-Refers-To: {_ID}"), refers_to.cast("string"), F.lit(">")),
        F.concat(F.lit("Content-Length: "), F.col("payload_bytes").cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n")).cast("binary")


def digested(pages: DataFrame) -> DataFrame:
    """page_id, url, payload with its length, SHA-1 (base32) and SHA-256 (address)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select("page_id", "url", payload.alias("payload")).select(
        "page_id", "url", "payload",
        F.length("payload").cast("long").alias("payload_bytes"),
        base32_of_hex(F.sha1("payload")).alias("payload_digest"),
        F.sha2("payload", 256).alias("address"),
    )


def write_archive(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    """Write the rows of ``pages`` (page_id, url, html) as an archive below ``folder``.

    Of the records with equal payloads of at least ``min_bytes`` bytes, the one with the
    smallest page_id is the response and the others revisit it; smaller ones are all
    responses. A null html is an empty payload. A record without a page_id is never the one
    referred to, unless no record of its payload has one: then all are responses. Repeated
    rows of the response are responses as well. Other columns of ``pages`` are not stored.
    """
    records = digested(pages)
    narrow = records.drop("payload")
    first = narrow.groupBy("address").agg(F.min("page_id").alias("first_id"))
    told = narrow.join(first, "address")
    revisit = (F.col("payload_bytes") >= min_bytes) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    told.select(
        "page_id", "address", _header(kind, F.when(revisit, F.col("first_id"))).alias("header")
    ).write.parquet(f"{folder}/headers")

    # one key for the join and for leaving out repeated rows, so that payloads move once
    who = F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("who")
    owners = first.select("address", F.col("first_id").alias("page_id")).select("address", who)
    once = (
        records.select("address", who, "payload")
        .join(owners, ["address", "who"], "left_semi")
        .dropDuplicates(["address", "who"])
    )
    once.select("address", "payload").write.option("compression", "zstd").parquet(f"{folder}/payloads")


def _field(name: str) -> Column:
    found = F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.nullif(found, F.lit(""))


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record, restored: the fields of its header, the header's and the payload's bytes.

    The payload's digests and length are computed again from the stored bytes and must equal
    what the header says; a record that fails this, or whose payload is missing, is an error.
    """
    headers = spark.read.parquet(f"{folder}/headers").select(
        "page_id", "address", "header",
        _field("WARC-Type").alias("record_type"),
        _field("WARC-Target-URI").alias("url"),
        F.regexp_extract(_field("WARC-Refers-To"), r":(-?\d+)>$", 1).try_cast("long").alias("refers_to"),
        F.regexp_extract(_field("WARC-Payload-Digest"), r"^sha1:(\w+)$", 1).alias("_said"),
        _field("Content-Length").try_cast("long").alias("_length"),
    )
    payloads = spark.read.parquet(f"{folder}/payloads").select(
        "address", "payload",
        F.length("payload").cast("long").alias("payload_bytes"),
        base32_of_hex(F.sha1("payload")).alias("payload_digest"),
        (F.sha2("payload", 256) == F.col("address")).alias("_sound"),
    )
    joined = headers.join(payloads, "address", "left")
    sound = (
        F.col("_sound")
        & (F.col("payload_digest") == F.col("_said"))
        & (F.col("payload_bytes") == F.col("_length"))
    )
    checked = F.when(F.coalesce(sound, F.lit(False)), F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("archive record is damaged: "), F.col("address"))).cast("string")
    )
    return joined.withColumn("payload_digest", checked).drop("_said", "_length", "_sound")


def record_bytes(records: DataFrame) -> DataFrame:
    """Adds ``record``: the bytes of the whole WARC record as in a file."""
    return records.withColumn(
        "record", F.concat(F.col("header"), F.col("payload"), F.lit("\r\n\r\n").cast("binary"))
    )
