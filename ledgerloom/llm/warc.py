"""Content-addressed WARC archive.

An archive is two Parquet tables below one path:

``payloads`` (digest, response_id, payload)     the bytes, once, under their SHA-256
``headers``  (record_id, uri, digest, header)   the exact header block of every record

A record is ``header + payload + CRLF CRLF`` for a response and ``header + CRLF CRLF`` for a
revisit; ``read_records`` rebuilds either by a join and verifies both digests of every payload.
Everything is DataFrame expressions.  Equal payloads are combined in each task before they are
shuffled, so a hot payload moves once for every task that holds it, not for every record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, tidy

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_END = "\r\n"
NO_DATE = "1970-01-01T00:00:00Z"
#: Fixed value of the format for revisits of an identical payload.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_of_hex(hex_digest: Column) -> Column:
    """Upper-case base32 of a 160-bit digest given as 40 hex digits (20 bits make 4 letters)."""
    letters = []
    for i in range(8):
        value = F.conv(F.substring(hex_digest, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(value, shift).bitwiseAND(F.lit(31)) + F.lit(1)
            letters.append(F.substring(F.lit(_BASE32), at, F.lit(1)))
    return F.concat(*letters)


def header_value(value: Column) -> Column:
    """Control characters percent-encoded, so that a value stays in its header line."""
    control = r"[\x00-\x1F\x7F]"
    safe = F.transform(F.split(value, ""), lambda c: F.when(c.rlike(control), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c))
    return F.when(value.rlike(control), F.array_join(safe, "")).otherwise(value)


def _header(kind: Column, own: Column, uri: Column, date: Column, length: Column, sha1: Column, refers: Column) -> Column:
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(_END))

    def urn(x: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), x.cast("string"), F.lit(">"))

    return F.concat(
        F.lit(f"WARC/1.1{_END}"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", F.coalesce(urn(own), F.lit("<urn:page:>"))),
        line("WARC-Date", date),
        F.when(uri.isNotNull(), line("WARC-Target-URI", header_value(uri))).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), sha1)),
        F.when(refers.isNotNull(), F.concat(line("WARC-Refers-To", urn(refers)), line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(refers.isNotNull(), F.lit(0)).otherwise(length).cast("string")),
        F.lit(_END),
    ).cast("binary")


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", text_col: str = "html",
    min_bytes: int = 0, date_col: str | None = None,
) -> None:
    """Write one record per row of ``pages``.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with the largest id is
    the response and the others revisit it; smaller payloads are all responses.  A null text is an
    empty payload, a text of any length is stored whole; a null uri leaves the header line out, and
    control characters in one are percent-encoded in the header.  ``date_col`` is a timestamp; where
    it is null or not named the records carry ``NO_DATE``.  Rows with a null id, and repeated rows,
    keep one record each: every row with the largest id is then a response, and so are rows with a
    null id where no row of that payload has an id.  An empty table makes an empty archive; extra
    columns are ignored, whatever their names.
    """
    spark = pages.sparkSession
    date = F.lit(NO_DATE) if date_col is None else F.coalesce(F.date_format(F.to_utc_timestamp(F.col(date_col), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(NO_DATE))
    page = pages.select(
        F.col(id_col).cast("long").alias("record_id"), F.col(uri_col).cast("string").alias("uri"), date.alias("date"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    with tidy(spark):
        page.groupBy("digest").agg(F.max("record_id").alias("response_id"), F.first("payload").alias("payload")).write.parquet(f"{path}/payloads")
        index = spark.read.parquet(f"{path}/payloads").select("digest", "response_id")
        facts = page.select(
            "record_id", "uri", "date", "digest", F.length("payload").cast("long").alias("length"), base32_of_hex(F.sha1("payload")).alias("sha1"),
        )
        revisit = (F.col("length") >= min_bytes) & (~F.col("record_id").eqNullSafe(F.col("response_id")))
        refers = F.when(revisit, F.col("response_id"))
        kind = F.when(refers.isNotNull(), F.lit("revisit")).otherwise(F.lit("response"))
        facts.join(index, "digest").select(
            "record_id", "uri", "digest",
            _header(kind, F.col("record_id"), F.col("uri"), F.col("date"), F.col("length"), F.col("sha1"), refers).alias("header"),
        ).write.parquet(f"{path}/headers")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """Parsed header fields of every record: type, own id, referred id, declared digest and length."""
    text = F.col("header").cast("string")

    def field(name: str) -> Column:
        return F.nullif(F.regexp_extract(text, rf"\r\n{name}: ([^\r\n]*)\r\n", 1), F.lit(""))

    return spark.read.parquet(f"{path}/headers").select(
        "record_id", "uri", "digest", "header",
        field("WARC-Type").alias("record_type"),
        F.regexp_extract(field("WARC-Refers-To"), r"<urn:page:(-?\d+)>", 1).cast("long").alias("refers_to"),
        F.regexp_extract(field("WARC-Payload-Digest"), r"^sha1:([A-Z2-7]{32})$", 1).alias("declared_sha1"),
        field("Content-Length").cast("long").alias("content_length"),
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Stored payloads with their length and SHA-1; fails if bytes do not match their address."""
    ok = F.sha2("payload", 256) == F.col("digest")
    return spark.read.parquet(f"{path}/payloads").select(
        "digest",
        F.when(ok, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "digest"))).alias("payload"),
    ).select(
        "digest", "payload", F.length("payload").cast("long").alias("payload_bytes"),
        base32_of_hex(F.sha1("payload")).alias("payload_digest"),
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record, rebuilt: header fields, full payload, and the record's exact bytes.

    Fails if a payload does not have the digest that its record declares.
    """
    end = F.lit(_END * 2).cast("binary")
    joined = read_headers(spark, path).join(read_payloads(spark, path), "digest")
    agreed = F.when(F.col("payload_digest") == F.col("declared_sha1"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("record without its payload "), F.coalesce(F.col("record_id").cast("string"), F.lit("null")))))
    return joined.withColumn("payload", agreed).withColumn(
        "record",
        F.when(F.col("record_type") == "response", F.concat("header", "payload", end)).otherwise(F.concat("header", end)),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, rebuild every record from the archive, report its payload."""
    path = Scratch(spark, "warc").path("archive")
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_records(spark, path).select(
        F.col("record_id").alias("page_id"), F.length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to",
    )


# DuckDB has no base32 and its sha1() gives hex, so the letters are built from 5 hex digits at a time.
_LETTER = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {a}, 5))::BIGINT >> {s}) & 31)::BIGINT + 1, 1)"
OP7_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, h, max(page_id) OVER (PARTITION BY body) AS top FROM p)
SELECT page_id, payload_bytes,
  {" || ".join(_LETTER.format(a=5 * i + 1, s=s) for i in range(8) for s in (15, 10, 5, 0))} AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM q
"""
