"""Per-round files of a season: CSV files with headers of their own, legacy JSON documents, inventories and profiles.

Files of one season differ in the order and number of their columns.  A first scan finds every file's
header; files with equal headers are read together by it, and the groups are united by name.
"""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PATTERN = r"(\d{4})-(\d+)"
CSV_FORMAT, LEGACY_FORMAT, NO_FORMAT = "CSV_ROUND_SNAPSHOT", "LEGACY_MARKET_JSON_TXT", "UNRECOGNIZED"


def _slot(path: Column, pattern: str) -> list[Column]:
    """Year and round of a path; null where it has none."""
    return [F.regexp_extract(path, pattern, i).try_cast("int").alias(name) for i, name in ((1, "year"), (2, "round"))]


def column_names(header: str, taken: tuple[str, ...] = ("year", "round", "file")) -> list[str]:
    """Names of a header line without byte order mark and outer space.

    An empty name becomes ``_c`` and its place; a name that occurs before it, or one of ``taken``, gets its place too.
    """
    names, used = [], {t.lower() for t in taken}
    for place, name in enumerate(next(csv.reader([header.lstrip("\ufeff")]), [])):
        name = name.strip() or f"_c{place}"
        if name.lower() in used:
            name = f"{name}_{place}"
        used.add(name.lower())
        names.append(name)
    return names


def csv_headers(spark: SparkSession, path: str, pattern: str = PATTERN) -> DataFrame:
    """(file, year, round, bytes, header): the first line with any text of every CSV file; files without one have no row.

    The first lines are those of the blocks at offset 0.  One scan numbers the lines and keeps the least number
    of a file, a second one the line of that number, so no lines are sorted; files are dealt to tasks alike both times.
    """
    meta = F.col("_metadata")
    lines = spark.read.text(path).select("value", meta["file_path"].alias("file"), meta["file_size"].alias("bytes"), meta["file_block_start"].alias("start"))
    first = lines.where((F.col("start") == 0) & (F.trim(F.replace("value", F.lit("\ufeff"), F.lit(""))) != "")).withColumn("at", F.monotonically_increasing_id())
    least = first.groupBy("file").agg(F.min("at").alias("at"))
    found = first.join(F.broadcast(least), ["file", "at"])
    return found.select("file", *_slot(F.col("file"), pattern), "bytes", F.col("value").alias("header"))


def csv_inventory(spark: SparkSession, path: str, pattern: str = PATTERN) -> DataFrame:
    """(file, year, round, bytes, format, columns): the column names of every file in its own order."""
    names = F.udf(lambda header: column_names(header), "array<string>")
    headers = csv_headers(spark, path, pattern)
    shapes = headers.select("header").distinct().select("header", names("header").alias("columns"))
    return headers.join(shapes, "header").select("file", "year", "round", "bytes", F.lit(CSV_FORMAT).alias("format"), "columns")


def read_round_csv(spark: SparkSession, path: str, pattern: str = PATTERN, multi_line: bool = False) -> DataFrame:
    """The rows of all CSV files below a path with ``year``, ``round`` and ``file``; every column is text.

    Each file is read by its own header, whatever the order of its columns; a column that a file lacks is
    null.  Names are matched whatever their case, and are spelled as in the first file by path.  A file's own column of the name year, round or file
    keeps its values under that name and its place.  Short rows end in nulls, what long rows have beyond
    the header goes.  The number of distinct headers, not that of the files, makes the plan grow; the
    driver holds the files' paths, as any reader does.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in csv_headers(spark, path, pattern).select("file", "header").collect():
        groups.setdefault(tuple(column_names(r.header)), []).append(unquote(r.file))
    file = F.col("_metadata.file_path").alias("file")
    parts = []
    for names, paths in sorted(groups.items(), key=lambda g: min(g[1])):
        schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
        rows = spark.read.schema(schema).option("header", True).option("multiLine", multi_line).option("quote", '"').option("escape", '"').csv(sorted(paths))
        parts.append(rows.select("*", file).select("*", *_slot(F.col("file"), pattern)))
    if not parts:
        return spark.range(0).selectExpr("cast(NULL AS string) AS file", "cast(NULL AS int) AS year", "cast(NULL AS int) AS round")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_legacy_json(spark: SparkSession, path: str, schema: str, pattern: str = PATTERN) -> DataFrame:
    """One row a file: (file, year, round, bytes, utf8, parsed, record); a file is one JSON text, pretty-printed or not.

    Text is UTF-8, or Latin-1 where the bytes are no UTF-8.  A text that is no JSON has parsed false and a null record.
    """
    content = F.col("content")
    utf8 = F.is_valid_utf8(content.cast("string"))
    text = F.ltrim(F.when(utf8, F.decode(content, "UTF-8")).otherwise(F.decode(content, "ISO-8859-1")), F.lit("\ufeff"))
    docs = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"), utf8.alias("utf8"), text.alias("text"))
    return docs.select(F.col("path").alias("file"), *_slot(F.col("path"), pattern), "bytes", "utf8", F.try_parse_json("text").isNotNull().alias("parsed"),
                       F.when(F.try_parse_json("text").isNotNull(), F.from_json("text", schema)).alias("record"))


def year_profile(rows: DataFrame, inventory: DataFrame, idents: list[str], years: DataFrame | None = None) -> DataFrame:
    """(year, files, rows, ids, min_round, max_round, columns, format).

    ``inventory`` has the files of each format; a year with round CSVs is profiled by them alone, else by
    its legacy documents.  An id is the first non-empty one of ``idents``.  ``columns`` are the sorted names
    of a year's files.  Years of ``years`` without a file are there with format ``UNRECOGNIZED`` and zeros.
    """
    known = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in idents if c in rows.columns]
    ident = F.coalesce(*known, F.lit(None).cast("string"))
    csv_year = inventory.groupBy("year").agg(F.bool_or(F.col("format") == CSV_FORMAT).alias("_csv"))
    files = inventory.join(csv_year, "year").where((F.col("format") == CSV_FORMAT) == F.col("_csv"))
    shapes = files.groupBy("year").agg(
        F.count("*").alias("files"), F.min("round").alias("min_round"), F.max("round").alias("max_round"),
        F.when(F.bool_or("_csv"), CSV_FORMAT).otherwise(LEGACY_FORMAT).alias("format"))
    columns = files.select("year", F.explode("columns").alias("_name")).distinct().groupBy("year").agg(F.array_join(F.array_sort(F.collect_list("_name")), ",").alias("columns"))
    counts = rows.groupBy("year").agg(F.count("*").alias("rows"), F.count_distinct(ident).alias("ids"))
    found = shapes.join(columns, "year", "left").join(counts, "year", "left")
    if years is not None:
        found = years.select("year").distinct().join(found, "year", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("files", "rows", "ids")}
    return found.withColumns(zero | {"format": F.coalesce("format", F.lit(NO_FORMAT)), "columns": F.coalesce("columns", F.lit(""))}).select(
        "year", "files", "rows", "ids", "min_round", "max_round", "columns", "format")
