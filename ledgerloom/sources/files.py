"""Sources, sinks, manifests and freezes.  Paths are read and written by Spark alone."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import lzma
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType, StringType


def read_records(spark: SparkSession, path: str, schema: str, field: str = "records", ok: str = "PASS", multi_line: bool = False) -> DataFrame:
    """Rows of an envelope {status, <field>: [...]}; an envelope that is not ``ok`` fails the read.

    One envelope a line, or with ``multi_line`` one a file.
    """
    env = spark.read.schema(f"status string, {field} array<struct<{schema}>>").json(path, multiLine=multi_line)
    good = F.when(F.col("status") == ok, F.col(field)).otherwise(F.raise_error(F.concat(F.lit("envelope status "), F.coalesce("status", F.lit("null")))))
    return env.select(F.explode(good).alias("r")).select("r.*")


def write_records(df: DataFrame, path: str, keys: list[str], fields: list[str], rows: int = 500, status: str = "PASS") -> None:
    """Envelopes {status, records: [...]} of about ``rows`` records each, one a line.

    The records of a key are split by a hash, so that no envelope grows with the table.
    """
    sizes = df.groupBy(*keys).agg(F.ceil(F.count("*") / rows).alias("_n"))
    dealt = df.join(sizes, keys).withColumn("_part", F.pmod(F.xxhash64(*fields), F.col("_n")))
    listed = dealt.groupBy(*keys, "_part").agg(F.collect_list(F.struct(*fields)).alias("records"))
    listed.select(F.lit(status).alias("status"), "records").write.json(path)


def _each(x: pa.Array, f, kind: pa.DataType) -> pa.Array:
    """f over the values of a batch; what it gives is Arrow soon, so few values are held as objects too."""
    out, held, size = [], [], 0
    for v in x:
        held.append(f(v.as_py()))
        size += len(held[-1] or "")
        if size > 1 << 20:
            out.append(pa.array(held, kind))
            held, size = [], 0
    return pa.concat_arrays([*out, pa.array(held, kind)])


@arrow_udf(BinaryType())
def decompress(x: pa.Array) -> pa.Array:
    """gzip or xz by their first bytes, null if damaged; anything else as it is."""

    def one(b):
        if b is None:
            return None
        try:
            return gzip.decompress(b) if b[:2] == b"\x1f\x8b" else lzma.decompress(b) if b[:6] == b"\xfd7zXZ\x00" else b
        except (OSError, EOFError, ValueError, zlib.error, lzma.LZMAError):
            return None

    return _each(x, one, pa.binary())


def _gzip(text: str) -> bytes:
    return gzip.compress(text.encode(), mtime=0)


@arrow_udf(BinaryType())
def gzipped(x: pa.Array) -> pa.Array:
    """gzip (fixed time stamp)."""
    return _each(x, lambda t: None if t is None else _gzip(t), pa.binary())


@arrow_udf(StringType())
def packed(x: pa.Array) -> pa.Array:
    """gzip (fixed time stamp) as base64."""
    return _each(x, lambda t: None if t is None else base64.b64encode(_gzip(t)).decode(), pa.string())


def chunk(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(key, idx, chunk, chunk_chars, chunk_sha256)."""
    n = F.ceil(F.length(text) / size).cast("int")
    rows = df.select(key, text, F.explode(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)).alias("idx"))
    piece = F.substring(F.col(text), F.col("idx") * size + 1, F.lit(size))
    return rows.select(key, "idx", piece.alias("chunk")).select("*", F.length("chunk").alias("chunk_chars"), F.sha2("chunk", 256).alias("chunk_sha256"))


def assemble(chunks: DataFrame, key: str, manifest: DataFrame | None = None) -> DataFrame:
    """(key, content, chunks, state): ordered chunks, each checked, joined, decoded, decompressed and checked as a whole.

    ``manifest`` has (key, payload_sha256) of the decoded payloads; a payload is there for each of its keys.
    States: ``INTACT``; ``CHUNK_DAMAGED`` (a chunk has other text or another length than it says);
    ``CHUNK_MISSING`` (the numbers from 0 on have a gap or one twice, or a payload has no chunk);
    ``NOT_DECODED`` (no base64, or no readable archive); ``HASH_DIFFERS`` (the payload is another one);
    ``UNLISTED`` (the manifest lacks the key).  Only intact content is given.
    """
    good = (F.length("chunk") == F.col("chunk_chars")) & (F.sha2("chunk", 256) == F.col("chunk_sha256"))
    listed = F.array_sort(F.collect_list(F.struct("idx", "chunk")))
    agg = chunks.groupBy(key).agg(listed.alias("c"), F.bool_and(F.coalesce(good, F.lit(False))).alias("ok"), F.count("*").alias("chunks"))
    in_order = F.transform("c", lambda x: x["idx"].cast("int")) == F.sequence(F.lit(0), F.col("chunks").cast("int") - 1)
    whole = F.array_join(F.transform("c", lambda x: x["chunk"]), "")
    agg = agg.select(key, "chunks", "ok", in_order.alias("ordered"), decompress(F.try_to_binary(F.when(F.col("ok") & in_order, whole), F.lit("base64"))).alias("content"))
    if manifest is not None:
        agg = agg.join(manifest.select(key, F.col("payload_sha256").alias("_sha"), F.lit(True).alias("_listed")), key, "full_outer")
    known = F.lit(True) if manifest is None else F.col("_listed").isNotNull()
    same = F.lit(True) if manifest is None else F.coalesce(F.sha2("content", 256) == F.lower("_sha"), F.lit(False))
    state = (
        F.when(F.col("chunks").isNull(), "CHUNK_MISSING").when(~F.col("ok"), "CHUNK_DAMAGED").when(~F.col("ordered"), "CHUNK_MISSING")
        .when(F.col("content").isNull(), "NOT_DECODED").when(~known, "UNLISTED").when(~same, "HASH_DIFFERS").otherwise("INTACT")
    )
    return agg.withColumn("state", state).select(key, F.when(F.col("state") == "INTACT", F.col("content")).alias("content"), F.coalesce("chunks", F.lit(0)).alias("chunks"), "state")


def pages(files: DataFrame) -> DataFrame:
    """(path, html, bytes, sha256, charset) of (path, content) page files, gzip, xz or plain.

    The hash is that of the decompressed bytes.  The charset is Latin-1 where a meta tag in the first 4 KB
    says so or the bytes are no UTF-8, else UTF-8.
    """
    raw = files.select("path", decompress("content").alias("content"))
    head = F.decode(F.substring("content", 1, 4096), "ISO-8859-1")
    named = F.upper(F.regexp_extract(head, "(?i)<meta[^>]*charset=[\"']?([\\w-]+)", 1))
    utf8 = F.is_valid_utf8(F.col("content").cast("string")) & ~named.isin("ISO-8859-1", "LATIN-1", "WINDOWS-1252")
    raw = raw.withColumn("charset", F.when(utf8, "UTF-8").otherwise("ISO-8859-1"))
    text = F.when(F.col("charset") == "UTF-8", F.decode("content", "UTF-8")).otherwise(F.decode("content", "ISO-8859-1"))
    return raw.select("path", text.alias("html"), F.octet_length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"), "charset")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``pages`` of the files below a path."""
    return pages(spark.read.format("binaryFile").load(path))


def zipped(members: DataFrame, archive: str, member: str, body: str) -> DataFrame:
    """(path, content): one zip archive per value of ``archive``, its members in name order.

    An archive is made in one piece; choose a key whose archives stay small.
    """
    def make(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for name, rows in zip(f["path"], f["m"]):
                b = io.BytesIO()
                with zipfile.ZipFile(b, "w") as z:
                    for r in sorted(rows, key=lambda r: r["name"]):
                        z.writestr(zipfile.ZipInfo(r["name"]), r["body"] or "")
                out.append((name, b.getvalue()))
            yield pd.DataFrame(out, columns=["path", "content"])

    listed = F.collect_list(F.struct(F.col(member).alias("name"), F.col(body).alias("body"))).alias("m")
    return members.groupBy(F.col(archive).alias("path")).agg(listed).mapInPandas(make, "path string, content binary")


def archive_members(files: DataFrame) -> DataFrame:
    """(archive, member, size, sha256, state) of every member of (path, content) zip files.

    Members come in name order and are hashed piece by piece, never held whole.  An archive that cannot be
    opened is one row of state ``NO_ARCHIVE`` without a member; a member that cannot be read or fails its
    checksum has state ``DAMAGED`` and no hash; all others are ``OK``.  Folders are left out.
    """

    def digest(z: zipfile.ZipFile, info: zipfile.ZipInfo) -> str:
        h = hashlib.sha256()
        with z.open(info) as f:
            while piece := f.read(1 << 20):
                h.update(piece)
        return h.hexdigest()

    def members(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for name, content in zip(f["path"], f["content"]):
                try:
                    z = zipfile.ZipFile(io.BytesIO(content or b""))
                except (zipfile.BadZipFile, ValueError, OSError):
                    rows.append((name, None, None, None, "NO_ARCHIVE"))
                    continue
                with z:
                    for info in sorted((i for i in z.infolist() if not i.is_dir()), key=lambda i: i.filename):
                        try:
                            rows.append((name, info.filename, info.file_size, digest(z, info), "OK"))
                        except (zipfile.BadZipFile, zlib.error, EOFError, OSError, RuntimeError, NotImplementedError):
                            rows.append((name, info.filename, info.file_size, None, "DAMAGED"))
            yield pd.DataFrame(rows, columns=["archive", "member", "size", "sha256", "state"]).astype({"size": "Int64"})

    return files.select("path", "content").mapInPandas(members, "archive string, member string, size long, sha256 string, state string")


def inventory_digest(members: DataFrame) -> DataFrame:
    """(archive, members, bytes, digest): the digest is that of an archive's lines ``member<TAB>size<TAB>sha256``; null unless all members are OK."""
    good = F.col("state") == "OK"
    line = F.concat_ws("\t", "member", F.col("size").cast("string"), "sha256")
    found = members.groupBy("archive").agg(F.count("member").alias("members"), F.sum("size").alias("bytes"), F.bool_and(good).alias("ok"), F.array_sort(F.collect_list(line)).alias("lines"))
    return found.select("archive", "members", "bytes", F.when(F.col("ok"), F.sha2(F.array_join("lines", "\n"), 256)).alias("digest"))


def archive_inventory(spark: SparkSession, path: str) -> DataFrame:
    """``archive_members`` of the zip files below a path."""
    return archive_members(spark.read.format("binaryFile").load(path))


def bundle_digest(files: DataFrame, bundle: str, path: Column, size: Column, sha: Column, trailing_newline: bool) -> DataFrame:
    """(bundle, files, digest): sha256 over the path-ordered lines ``path<TAB>size<TAB>sha``, with or without a last newline.

    The digest runs over a bundle from its first line to its last, so a bundle is one task's work; its
    lines are sorted by Spark and read as a stream, never held together.  Files of one path stay several lines.
    """
    line = F.concat_ws("\t", path, size.cast("string"), sha)
    rows = files.select(F.col(bundle).alias("_bundle"), line.alias("_line"), path.alias("_path"))
    kind = rows.schema["_bundle"].dataType.simpleString()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, h, field = None, 0, None, None

        def ended() -> pa.RecordBatch:
            if trailing_newline:
                h.update(b"\n")
            return pa.RecordBatch.from_arrays([pa.array([now], field), pa.array([n], pa.int64()), pa.array([h.hexdigest()])], [bundle, "files", "digest"])

        for batch in batches:
            field = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if h is not None and key != now:
                    yield ended()
                    h = None
                if h is None:
                    now, n, h = key, 0, hashlib.sha256()
                h.update((b"\n" if n else b"") + text.encode())
                n += 1
        if h is not None:
            yield ended()

    dealt = rows.repartition("_bundle").sortWithinPartitions("_bundle", "_path", "_line").select("_bundle", "_line")
    return dealt.mapInArrow(fold, f"`{bundle}` {kind}, files long, digest string")


def freeze_compare(fresh: DataFrame, frozen: DataFrame, path: str, sha: str) -> DataFrame:
    """unchanged, changed, new or missing per path; a change asks for a new version."""
    j = fresh.select(path, F.col(sha).alias("a"), F.lit(True).alias("_f")).join(frozen.select(path, F.col(sha).alias("b"), F.lit(True).alias("_z")), path, "full_outer")
    return j.select(path, F.when(F.col("_z").isNull(), "new").when(F.col("_f").isNull(), "missing").when(F.col("a").eqNullSafe(F.col("b")), "unchanged").otherwise("changed").alias("state"))


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Fixed column order, quotes doubled, null as an empty field."""
    (df.select(*columns) if columns else df).write.option("header", True).option("quote", '"').option("escape", '"').option("nullValue", "").option("emptyValue", '""').csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').csv(path)
