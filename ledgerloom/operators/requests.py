"""What to ask for next, and how much of it came back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_entities(referenced: DataFrame, fetched: DataFrame, key: str) -> DataFrame:
    """Referenced rows whose key has not been fetched; a null key is never fetched."""
    return referenced.join(fetched.select(key).distinct(), key, "left_anti")


def grid(entities: DataFrame, modes: DataFrame, results: DataFrame, entity: str, mode: str, value: str, valid: Column) -> DataFrame:
    """Every cell of entities x modes with its result (0 without one), validity, and the entity's first valid mode.

    ``modes`` is a short list; Spark broadcasts it where it is small enough.
    """
    cells = entities.select(entity).distinct().crossJoin(modes.select(mode).distinct()).join(results.select(entity, mode, value), [entity, mode], "left")
    cells = cells.withColumn(value, F.coalesce(value, F.lit(0))).withColumn("valid", valid)
    chosen = cells.where("valid").groupBy(entity).agg(F.min(mode).alias("mode"))
    return cells.join(chosen, entity, "left")


def request_plan(available: DataFrame, entity: str, season: str, window: list[int], modes: list[str]) -> DataFrame:
    """(entity, season, mode) jobs: seasons that an entity has within the window, once for every mode."""
    jobs = available.where(F.col(season).isin(window)).select(entity, season).distinct()
    return jobs.select("*", F.explode(F.array(*[F.lit(m) for m in modes])).alias("mode"))


def observation_routes(links: DataFrame, subject: str, ident: str, season: str) -> DataFrame:
    """(subject, ident, season): every id of a subject with every season of the subject.

    Ids and seasons meet in a join on the subject, so no subject is collected into one row.
    """
    return links.select(subject, ident).distinct().join(links.select(subject, season).distinct(), subject)


def coverage_rate(expected: DataFrame, obtained: DataFrame, keys: list[str], group: list[str]) -> DataFrame:
    """Expected references, those obtained on all keys, and their share, per group."""
    there = obtained.select(*keys).distinct().withColumn("_hit", F.lit(1))
    return expected.join(there, keys, "left").groupBy(*group).agg(
        F.count("*").alias("expected"), F.count("_hit").alias("matched"), (F.count("_hit") / F.count("*")).alias("rate"))


def backjoin(later: DataFrame, earlier: DataFrame, key: str, value: str, missing: str = "MISSING") -> DataFrame:
    """Rows of a later pass with the earlier pass's value; ``missing`` where that has no such key."""
    right = earlier.select(key, F.col(value).alias("earlier"))
    return later.join(right, key, "left").withColumn("earlier", F.coalesce("earlier", F.lit(missing)))
