"""A content-addressed web archive: payload bytes once, exact WARC record headers beside them, records put together by joins.

``write_archive`` makes two tables in a folder. ``payloads`` holds the bytes of each distinct payload once, under their
SHA-256. ``headers`` holds for each record the exact header block of WARC/1.1 and the address of its payload. Of the records
with equal payloads of at least ``revisit_bytes``, the one with the largest page id is the response, the others are revisits
that refer to it. ``read_archive`` parses the headers, joins the payloads and holds their SHA-1 and length against the headers;
``records`` gives the bytes of whole records.

Payloads are grouped by address and bytes, so equal addresses are verified by the bytes themselves: two payloads under one
address are an error, not one record. A payload that many pages share is reduced within each task before it is shuffled, and
only narrow rows (page id, address) are joined, which adaptive execution splits where one address is hot.

Odd input: a null html is an empty payload. Repeated rows give a record each; all that share the largest id are responses. A
null page id is smaller than any other and is written as an empty id; without any id in a group all its records are responses. A
null url has no header line; line ends and other control characters in a url are written as ``%XX``, and so the read url has them.
Texts of any length are one payload, at most 2 GB, as in any column. Empty tables give an empty archive. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Payloads of fewer bytes are stored once too, but each of their records is a response.
REVISIT_BYTES = 1000

CRLF = "\r\n"
#: Fixed values of the record format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _payload() -> Column:
    return F.coalesce("html", F.lit("")).cast("binary")


def _one_line(url: Column) -> Column:
    """The url without characters that would end a header line."""
    plain = url
    for code in (*range(0x20), 0x7F):
        plain = F.replace(plain, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(url.rlike(r"[\x00-\x1F\x7F]"), plain).otherwise(url)


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _header(date: str) -> Column:
    """Header block of a record, up to and with the empty line."""
    revisit = F.col("refers_to").isNotNull()

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    return F.concat(
        F.lit(VERSION + CRLF),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(F.col("page_id"))),
        F.coalesce(line("WARC-Target-URI", _one_line(F.col("url"))), F.lit("")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", _record_id(F.col("refers_to"))), line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes")).cast("string")),
        F.lit(CRLF),
    )


def write_archive(
    pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES, date: str = "1970-01-01T00:00:00Z"
) -> None:
    spark = pages.sparkSession
    keyed = pages.select("page_id", "url", _payload().alias("payload"))
    address = F.unhex(F.sha2("payload", 256)).alias("address")
    stored = keyed.select("page_id", address, "payload").groupBy("address", "payload").agg(F.max("page_id").alias("last_id"))
    stored.select(
        "address", "last_id", F.octet_length("payload").cast("long").alias("n_bytes"), F.sha1("payload").alias("sha1"), "payload"
    ).write.option("compression", "zstd").parquet(f"{path}/payloads")
    known = spark.read.parquet(f"{path}/payloads").drop("payload")
    if known.groupBy("address").count().where("count > 1").limit(1).count():
        raise ValueError("two payloads under one address")
    is_revisit = (F.col("n_bytes") >= revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("last_id"))
    records = (
        keyed.select("page_id", "url", address)
        .join(known, "address", "left")
        .withColumn("refers_to", F.when(is_revisit, F.col("last_id")))
    )
    records.select(_header(date).cast("binary").alias("header"), "address").write.option("compression", "zstd").parquet(f"{path}/headers")


def _field(name: str) -> Column:
    found = F.regexp_extract("head", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(F.contains(F.col("head"), F.lit(f"{CRLF}{name}: ")), found)


def _page_id(field: Column) -> Column:
    return F.nullif(F.regexp_extract(field, r"^<urn:page:(-?\d*)>$", 1), F.lit("")).cast("long")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, url, record_type, refers_to, payload_digest, payload_bytes, header and payload.

    A payload that is missing, or whose length or digest is not what its header says, is an error. Without the payload
    column only digests and lengths are joined.
    """
    head = F.col("header").cast("string")
    headers = spark.read.parquet(f"{path}/headers").withColumn("head", head)
    parsed = headers.select(
        "address",
        "header",
        _page_id(_field("WARC-Record-ID")).alias("page_id"),
        _field("WARC-Target-URI").alias("url"),
        _field("WARC-Type").alias("record_type"),
        _page_id(_field("WARC-Refers-To")).alias("refers_to"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("said_digest"),
        _field("Content-Length").cast("long").alias("said_bytes"),
    )
    stored = spark.read.parquet(f"{path}/payloads").select(
        "address", "payload", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("n_bytes")
    )
    whole = (F.col("sha1") == F.col("said_digest")) & ((F.col("record_type") == "revisit") | (F.col("n_bytes") == F.col("said_bytes")))
    checked = F.when(whole, F.col("sha1")).otherwise(F.raise_error(F.concat(F.lit("damaged record "), F.col("header").cast("string"))).cast("string"))
    return parsed.join(stored, "address", "left").select(
        "page_id", "url", "record_type", "refers_to", checked.alias("payload_digest"), F.col("n_bytes").alias("payload_bytes"), "header", "payload"
    )


def records(archive: DataFrame) -> DataFrame:
    """(page_id, record): the bytes of each record as a WARC file holds them; a revisit has no payload of its own."""
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return archive.select("page_id", F.concat("header", body, F.lit((CRLF * 2).encode())).alias("record"))
