"""Rules on single provider records: projections, keys, statuses and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_keys(df: DataFrame, text: str, required: list[str], group: list[str]) -> DataFrame:
    """(group, missing, rows): required keys that JSON objects lack; a text that is no object lacks them all."""
    there = F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))
    gone = F.array_except(F.array(*[F.lit(k) for k in required]), there)
    return df.select(*group, F.explode(gone).alias("missing")).groupBy(*group, "missing").agg(F.count("*").alias("rows"))


def scalar_columns(df: DataFrame) -> DataFrame:
    """The columns that hold no struct, array, map or variant."""
    nested = ("struct", "array", "map", "variant")
    return df.select(*[f"`{f.name}`" for f in df.schema.fields if f.dataType.typeName() not in nested])


def allowlist(df: DataFrame, columns: dict[str, list[Column]], locator: tuple[str, list[Column]] | None = None) -> DataFrame:
    """Only the listed columns, each the first non-null of its sources, and a path built of ``locator`` parts.

    A locator with a null part is null.
    """
    kept = [F.coalesce(*sources).alias(name) for name, sources in columns.items()]
    if locator:
        name, parts = locator
        slashed = [x for p in parts for x in (F.lit("/"), p.cast("string"))][1:]
        kept.append(F.concat(*slashed).alias(name))
    return df.select(*kept)


def open_records(df: DataFrame, done: dict[str, str]) -> DataFrame:
    """Rows that are not done in every named column; null counts as open."""
    closed = F.lit(True)
    for column, value in done.items():
        closed = closed & F.col(column).eqNullSafe(F.lit(value))
    return df.where(~closed)


def route_residuals(df: DataFrame, scope: str, subject: str, routes: dict[str, Column]) -> DataFrame:
    """Rows per route and distinct subjects, for every scope and (scope null) over all."""
    return df.groupingSets([[F.col(scope)], []], scope).agg(
        *[F.count_if(c).alias(name) for name, c in routes.items()], F.count_distinct(subject).alias("subjects"))


def availability(missing: Column, required: Column, corrupt: Column, mismatch: Column | None = None) -> Column:
    """Status of an expected file: only a missing required one, a wrong name or a corrupt one is a failure."""
    status = F.when(missing & required, "FAILED_REQUIRED").when(missing, "UNAVAILABLE_OPTIONAL")
    if mismatch is not None:
        status = status.when(mismatch, "NAME_MISMATCH")
    return status.when(corrupt, "CORRUPT").otherwise("AVAILABLE")


def scope_snapshots(df: DataFrame, entity: str, step: Column, valid: Column, values: list[Column]) -> DataFrame:
    """Valid rows as totals per entity and as one row per step, stacked: (entity, scope, round, values)."""
    rows = df.where(valid).withColumn("_step", step)
    total = rows.groupBy(entity).agg(*values).withColumn("scope", F.lit("total")).withColumn("round", F.lit(None).cast(rows.schema["_step"].dataType))
    rounds = rows.groupBy(entity, F.col("_step").alias("round")).agg(*values).withColumn("scope", F.lit("round"))
    return total.unionByName(rounds)


def extract_id(text: Column, keys: list[str], patterns: list[str]) -> Column:
    """The first digits-only value among JSON keys, then among the first groups of patterns, as a number.

    Digits that pass 64 bits are no id; the next candidate counts.
    """
    def digits(x: Column) -> Column:
        return F.when(x.rlike(r"^[0-9]+$"), x).try_cast("long")

    return F.coalesce(*[digits(F.get_json_object(text, f"$.{k}")) for k in keys], *[digits(F.regexp_extract(text, p, 1)) for p in patterns])


def classify(value: Column, names: dict[str, list[str]], prefixes: dict[str, str], otherwise: str = "other") -> Column:
    """Class of a slug: exact lower-case names first, then prefixes."""
    out = None
    for kind, slugs in names.items():
        out = (F if out is None else out).when(F.lower(value).isin(slugs), kind)
    for prefix, kind in prefixes.items():
        out = (F if out is None else out).when(F.startswith(value, F.lit(prefix)), kind)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def bridge_key(explicit: Column, provider_id: Column, subject: Column, pattern: str, prefix: str = "provider:") -> Column:
    """An explicit key, else a digits-only provider id, else the digits that ``pattern`` finds in the subject."""
    linked = F.when(provider_id.cast("string").rlike(r"^\d+$"), F.concat(F.lit(prefix), provider_id.cast("string")))
    return F.coalesce(explicit, linked, F.concat(F.lit(prefix), F.nullif(F.regexp_extract(subject, pattern, 1), F.lit(""))))


def technical_ids(df: DataFrame, derived: Column, given: str) -> DataFrame:
    """One row: rows, ids that are not the derived one (null included), and whether derived ids are unique."""
    rows = df.select(derived.alias("_wanted"), F.col(given).alias("_given"))
    return rows.agg(
        F.count("*").alias("rows"), F.count_if(~F.col("_wanted").eqNullSafe(F.col("_given"))).alias("not_canonical"),
        (F.count_distinct("_wanted") == F.count("*")).alias("unique"))


def record_checks(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Every check as a column and VERIFIED where all hold, else REVIEW; a check that is null does not hold."""
    held = [F.coalesce(c, F.lit(False)) for c in checks.values()]
    ok = F.forall(F.array(*held), lambda x: x)
    return df.select("*", *[c.alias(k) for k, c in zip(checks, held)], F.when(ok, "VERIFIED").otherwise("REVIEW").alias("status"))


def expected_path(value: Column, segments: list[Column]) -> Column:
    """Whether the path of a url holds every segment exactly."""
    path = F.split(F.regexp_replace(F.regexp_replace(value, r"^https?://[^/]+", ""), r"[?#].*$", ""), "/")
    ok = F.lit(True)
    for s in segments:
        ok = ok & F.array_contains(path, s)
    return ok


def country_codes(value: Column, codes: dict[str, str]) -> Column:
    """The listed code of a name, else its first three letters in upper case."""
    pairs = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.coalesce(pairs[value], F.upper(F.substring(value, 1, 3)))
