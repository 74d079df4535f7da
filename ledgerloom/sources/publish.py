"""Staged publication of audited tables.

A table is written under a name of its own, audited from what was written, and only then named by a
manifest.  Readers follow manifests alone, so they never see a table that failed or is half written,
and nothing is ever moved or overwritten:

    <path>/data/<unique name>/     the rows of one attempt
    <path>/audits/<unique name>/   its audit, whatever the outcome
    <path>/manifests/version=<n>/  names the data of version n; written once, after a passed audit
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import delete

_MANIFEST = "name string, rows long, digest string, status string"


class AuditFailed(ValueError):
    """The audit's status was not the one that allows publication."""


class Published(NamedTuple):
    version: int
    name: str
    rows: int
    digest: str
    new: bool


def content_digest(df: DataFrame) -> tuple[int, str]:
    """(rows, digest) of the rows as a bag: neither their order nor their partitions count, repeated rows do.

    Sums of two 64-bit hashes and of their product, as decimals; one partial aggregate a task is shuffled.
    """
    cols = sorted(df.columns)
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]), {"ignoreNullFields": "false"})
    big = "decimal(38,0)"
    sums = [F.coalesce(F.sum(F.xxhash64(row, F.lit(seed)).cast(big)), F.lit(0).cast(big)).cast("string") for seed in (1, 2)]
    n, one, two = df.agg(F.count("*"), *sums).first()
    shape = ",".join(f"{c}:{df.schema[c].dataType.simpleString()}" for c in cols)
    return n, df.sparkSession.range(1).select(F.sha2(F.lit(f"{shape}|{n}|{one}|{two}"), 256)).first()[0]


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """(version, name, rows, digest, status) of all published versions; none if nothing is published."""
    try:
        found = spark.read.schema(f"{_MANIFEST}, version int").option("basePath", f"{path}/manifests").json(f"{path}/manifests/version=*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(0).selectExpr("cast(NULL AS int) AS version", "cast(NULL AS string) AS name", "id AS rows", "cast(NULL AS string) AS digest", "cast(NULL AS string) AS status")
    return found.select("version", "name", "rows", "digest", "status")


def latest(spark: SparkSession, path: str) -> Published | None:
    row = manifests(spark, path).orderBy(F.desc("version")).first()
    return row and Published(row.version, row.name, row.rows, row.digest, False)


def publish(df: DataFrame, path: str, audit: Callable[[DataFrame], DataFrame], ok: str = "PASS") -> Published:
    """Write, audit and publish ``df``; the next version, or the last one if the content is the same.

    ``audit`` gets the rows as they were written and gives one row with a ``status``.  Any status but
    ``ok``, or no row, raises ``AuditFailed``: the audit stays, the rows go, readers keep the last
    version.  A failure before or during the audit leaves the last version as well; what it leaves behind is named by no
    manifest.  Two publishers that reach the same version: the second one fails and may try again.
    """
    spark = df.sparkSession
    name = uuid.uuid4().hex
    df.write.parquet(f"{path}/data/{name}")
    written = spark.read.schema(df.schema).parquet(f"{path}/data/{name}")
    audit(written).write.json(f"{path}/audits/{name}")
    checked = spark.read.schema("status string").json(f"{path}/audits/{name}").take(2)
    if [r.status for r in checked] != [ok]:
        delete(spark, f"{path}/data/{name}")
        raise AuditFailed(f"audit status {[r.status for r in checked]}")
    rows, digest = content_digest(written)
    last = latest(spark, path)
    if last and last.digest == digest:
        delete(spark, f"{path}/data/{name}")
        return last
    version = last.version + 1 if last else 1
    line = spark.range(1).select(F.lit(name).alias("name"), F.lit(rows).alias("rows"), F.lit(digest).alias("digest"), F.lit(ok).alias("status"))
    line.coalesce(1).write.mode("error").json(f"{path}/manifests/version={version}")
    return Published(version, name, rows, digest, True)


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the last one by default; an unpublished version is an error."""
    known = manifests(spark, path)
    row = (known if version is None else known.where(F.col("version") == version)).orderBy(F.desc("version")).first()
    if row is None:
        raise LookupError(f"{path} has no published version" + ("" if version is None else f" {version}"))
    return spark.read.parquet(f"{path}/data/{row.name}")


def audits(spark: SparkSession, path: str) -> DataFrame:
    """(name, status, published) of every audited attempt."""
    tried = spark.read.schema("status string").json(f"{path}/audits/*").select(F.regexp_extract("_metadata.file_path", "/audits/([^/]+)/", 1).alias("name"), "status")
    return tried.join(manifests(spark, path).select("name", F.lit(True).alias("published")), "name", "left").select("name", "status", F.coalesce("published", F.lit(False)).alias("published"))
