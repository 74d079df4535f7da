"""Club identity: season snapshots, the match cascade, registries, candidates and reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def snapshot_year(label: Column) -> Column:
    """Pre-season snapshot of a ``YYYY-YY`` label; any other label is an error."""
    good = label.rlike(r"^\d{4}-\d{2}$")
    return F.when(good, F.substring(label, 1, 4).cast("int")).otherwise(F.raise_error(F.concat(F.lit("bad season label "), label)).cast("int"))


def one_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The best row of every key (smallest ``order``), kept as a struct-free row."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_b"))
    return best.select(*keys, "_b.*")


def exact_match(facts: DataFrame, clubs: DataFrame) -> DataFrame:
    """Left join on (snapshot_year, association, norm); several clubs of one name give the best rank."""
    best = one_per_key(clubs.select("snapshot_year", "association", "norm", "club", "coefficient", "rank"), ["snapshot_year", "association", "norm"], ["rank", "club"])
    return facts.join(best, ["snapshot_year", "association", "norm"], "left")


def cascade(facts: DataFrame, clubs: DataFrame, aliases: DataFrame, no_history: DataFrame) -> DataFrame:
    """Match every (snapshot_year, association, norm) row, in this order:

    exact in the snapshot; reviewed alias in the snapshot; alias whose target is absent from it; exact
    in another snapshot only; reviewed as without history; else REVIEW_REQUIRED.  Right sides have one
    row per key, so rows neither fan out nor get lost.
    """
    cols = ["snapshot_year", "association", "norm", "club", "coefficient", "rank"]
    best = one_per_key(clubs.select(*cols), cols[:3], ["rank", "club"])
    exact = best.select(*cols[:3], F.col("club").alias("_ec"), F.col("coefficient").alias("_ev"))
    target = best.select("snapshot_year", "association", F.col("norm").alias("_target"), F.col("club").alias("_ac"), F.col("coefficient").alias("_av"))
    anywhere = best.groupBy("association", "norm").agg(F.min_by("club", F.struct("snapshot_year", "rank")).alias("_gc"))
    alias = aliases.groupBy("association", "norm").agg(F.min("target").alias("_target"))
    known = no_history.select("association", "norm").distinct().withColumn("_none", F.lit(True))
    joined = (
        facts.join(exact, cols[:3], "left").join(alias, ["association", "norm"], "left")
        .join(target, ["snapshot_year", "association", "_target"], "left").join(anywhere, ["association", "norm"], "left")
        .join(known, ["association", "norm"], "left")
    )
    method = (
        F.when(F.col("_ec").isNotNull(), "EXACT").when(F.col("_ac").isNotNull(), "ALIAS").when(F.col("_target").isNotNull(), "ALIAS_ABSENT")
        .when(F.col("_gc").isNotNull(), "GLOBAL_EXACT_ABSENT").when(F.col("_none"), "NO_HISTORY").otherwise("REVIEW_REQUIRED")
    )
    named = joined.withColumn("method", method)
    status = F.when(F.col("method").isin("EXACT", "ALIAS"), "MATCHED").when(F.col("method") == "REVIEW_REQUIRED", "REVIEW_REQUIRED").otherwise("NO_COEFFICIENT")
    return named.select(*facts.columns, "method", status.alias("status"), F.coalesce("_ec", "_ac", F.when(F.col("method") == "GLOBAL_EXACT_ABSENT", F.col("_gc"))).alias("club"),
                        F.coalesce("_ev", "_av").alias("coefficient"))


def registry_errors(aliases: DataFrame, no_history: DataFrame, clubs: DataFrame) -> DataFrame:
    """(error, association, norm): duplicate_alias, alias_target_absent, in_both, no_history_matches."""
    key = ["association", "norm"]
    twice = aliases.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    absent = aliases.join(clubs.select("association", F.col("norm").alias("target")).distinct(), ["association", "target"], "left_anti")
    both = aliases.select(*key).distinct().join(no_history.select(*key).distinct(), key, "left_semi")
    matching = no_history.select(*key).distinct().join(clubs.select(*key).distinct(), key, "left_semi")
    parts = {"duplicate_alias": twice, "alias_target_absent": absent, "in_both": both, "no_history_matches": matching}
    out = None
    for name, df in parts.items():
        rows = df.select(F.lit(name).alias("error"), *key).distinct()
        out = rows if out is None else out.unionByName(rows)
    return out


def candidate_rollup(ranked: DataFrame, identity: list[str], other: str, k: int = 8) -> DataFrame:
    """Per identity: candidates over all snapshots by best score, appearances and mean score."""
    agg = ranked.groupBy(*identity, other).agg(F.count("*").alias("appearances"), F.max("score").alias("best"), F.sum(F.round(F.col("score") * 1000000).cast("long")).alias("_s"))
    agg = agg.withColumn("mean_micro", F.col("_s") / F.col("appearances"))
    at = F.row_number().over(Window.partitionBy(*identity).orderBy(F.desc("best"), F.desc("appearances"), F.desc("mean_micro"), other))
    return agg.withColumn("place", at).where(F.col("place") <= k).select(*identity, other, "appearances", "best", "place")


def review_groups(rows: DataFrame, identity: list[str], season: str, candidates: DataFrame | None = None, other: str = "other") -> DataFrame:
    """(identity, seasons, rows, candidates): one row an identity, its seasons in order and the candidates of each.

    ``candidates`` has (identity, season, ``other``, score, place); ``candidates`` of the result are (season,
    names) structs, the names best first.  Identities have few seasons and candidates by nature.
    """
    found = rows.groupBy(*identity).agg(F.array_sort(F.collect_set(season)).alias("seasons"), F.count("*").alias("rows"))
    if candidates is None:
        return found
    per = candidates.groupBy(*identity, season).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", other))), lambda x: x[other]).alias("names"))
    listed = per.groupBy(*identity).agg(F.array_sort(F.collect_list(F.struct(season, "names"))).alias("candidates"))
    return found.join(listed, identity, "left")


def short_name_match(short: DataFrame, full: DataFrame, key: list[str]) -> DataFrame:
    """``Surname I.`` against full token arrays.

    Blocks on the longest base token; every base token must be a token of the full name or lie inside
    the joined name, and another token must start with the initial (1-4 letters).
    """
    base = F.slice("tokens", 1, F.size("tokens") - 1)
    left = short.withColumn("initial", F.regexp_replace(F.element_at("tokens", -1), r"\.", "")).withColumn("base", base)
    left = left.where((F.size("base") > 0) & F.length("initial").between(1, 4))
    left = left.withColumn("_t", F.array_max(F.transform("base", lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))["t"])
    right = full.withColumn("_t", F.explode(F.array_distinct("full_tokens")))
    joined = F.array_join("full_tokens", "")
    ok = F.forall("base", lambda t: F.array_contains("full_tokens", t) | F.contains(joined, t)) & F.exists(
        F.array_except("full_tokens", "base"), lambda t: F.startswith(t, F.col("initial")))
    return left.join(right, [*key, "_t"]).where(ok)
