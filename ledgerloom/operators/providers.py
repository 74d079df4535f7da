"""Provider payloads to one neutral index: projection, lookups, dedupe, versions, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.shared import work_folder

INDEX_COLUMNS = [
    "provider", "competition", "season", "provider_player_id", "player_name", "team", "source_url", "source_local_path", "source_sha256", "record_type",
    "provider_fields_json",
]


def truthy(*values: Column) -> Column:
    """The first value that is neither null, empty, blank nor 0, as text."""
    return F.coalesce(*[F.when(~F.trim(v.cast("string")).isin("", "0", "0.0", "false"), F.trim(v.cast("string"))) for v in values])


def clean_name(*values: Column) -> Column:
    return F.regexp_replace(truthy(*values), r"\s+", " ")


def to_index(df: DataFrame, provider: str, mapping: dict[str, Column], record_type: str = "player") -> DataFrame:
    """The 11 neutral columns; what is not mapped is null, and the whole row is kept as JSON."""
    fixed = {"provider": F.lit(provider), "record_type": F.lit(record_type), "provider_fields_json": F.to_json(F.struct("*"))}
    return df.select(*[(fixed | mapping).get(c, F.lit(None)).cast("string").alias(c) for c in INDEX_COLUMNS])


def dim_lookup(facts: DataFrame, dim: DataFrame, key: str, dim_key: str, small: bool = False) -> DataFrame:
    """Left join of a dimension; ``small`` marks a dimension whose size the caller has checked."""
    right = F.broadcast(dim) if small else dim
    return facts.join(right, facts[key] == right[dim_key], "left").drop(right[dim_key])


def payload_versions(df: DataFrame, entity: str, param: str, sha: str) -> DataFrame:
    """Per (entity, payload hash): its parameters, the smallest as representative, and a label.

    UNVERSIONED_CURRENT when the entity's only hash answers several parameters, else PARAM_<smallest>.
    Only hashes shuffle; bodies are joined back by the representative.
    """
    groups = df.groupBy(entity, sha).agg(F.min(param).alias("representative"), F.count_distinct(param).alias("params"))
    hashes = groups.groupBy(entity).agg(F.count("*").alias("hashes"))
    label = F.when((F.col("hashes") == 1) & (F.col("params") > 1), "UNVERSIONED_CURRENT").otherwise(F.concat(F.lit("PARAM_"), F.col("representative")))
    return groups.join(hashes, entity).select(entity, sha, "representative", "params", label.alias("version"))


def echo_check(df: DataFrame, asked: str, echoed: str) -> Column:
    """verified, mismatch or not_echoed for a requested and an echoed parameter."""
    return F.when(F.col(echoed).isNull(), "not_echoed").when(F.col(asked).eqNullSafe(F.col(echoed)), "verified").otherwise("mismatch")


def null_safe_difference(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose composite key, nulls included, is not in ``old``."""
    right = old.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    condition = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_{k}"))
        condition = same if condition is None else condition & same
    return new.join(right, condition, "left_anti")


def control_compare(df: DataFrame, control: DataFrame, entity: str, sha: str) -> DataFrame:
    """Whether a payload differs from the entity's control payload: distinct, same_payload, failed."""
    right = control.groupBy(F.col(entity).alias("_e")).agg(F.min(sha).alias("_c"))
    return df.join(right, F.col(entity) == F.col("_e"), "left").withColumn(
        "comparison", F.when(F.col(sha).isNull() | F.col("_c").isNull(), "failed").when(F.col(sha) == F.col("_c"), "same_payload").otherwise("distinct"),
    ).drop("_e", "_c")


def reach(seeds: DataFrame, edges: DataFrame, max_depth: int = 5) -> DataFrame:
    """(node, page, depth): pages spread from seed nodes along parent -> child edges, smallest depth first.

    Every step joins only the frontier; what is reached and what was known meet in one aggregation, so
    cycles end, and the spread stops when a step finds nothing new or at ``max_depth``.  Edges stay dealt
    by their parent between steps.  Each frontier is written to the shared folder, so no step repeats the
    work of another.
    """
    spark = seeds.sparkSession
    root = work_folder(spark, "reach")
    links = edges.select("parent", "child").distinct().repartition("parent").persist()
    seeds.select("node", "page").distinct().withColumn("depth", F.lit(0)).write.parquet(f"{root}/depth=0")
    known = spark.read.parquet(f"{root}/depth=0")
    last = known
    for d in range(1, max_depth + 1):
        step = last.join(links, F.col("node") == F.col("parent")).select(F.col("child").alias("node"), "page", F.lit(d).alias("depth"))
        found = step.unionByName(known).groupBy("node", "page").agg(F.min("depth").alias("depth")).where(F.col("depth") == d)
        found.write.parquet(f"{root}/depth={d}")
        last = spark.read.parquet(f"{root}/depth={d}")
        if last.isEmpty():
            break
        known = known.unionByName(last)
    links.unpersist()
    return known
