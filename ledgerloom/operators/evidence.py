"""Evidence about persons: candidates, context, statements, observations, consensus, conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERIFIED, AMBIGUOUS, UNRESOLVED = "VERIFIED", "AMBIGUOUS", "UNRESOLVED"
#: Parts that the bearers of one name are dealt to.
PARTS = 16


def name_candidates(subjects: DataFrame, entities: DataFrame, claims: list[str]) -> DataFrame:
    """(subject, n, entity, status): distinct entities that bear one of a subject's names and all claims.

    ``subjects`` has a names array, ``entities`` names and claims arrays.  Subjects with the same names
    are one, and an entity counts under a name once: what joins is (set of names, name) with a name's
    entities, in ``PARTS`` parts by a hash of the entity, each counted before the parts are summed.  A
    common name is thus split, and its bearers are never listed in one place.
    """
    parts = F.lit(PARTS)
    named = subjects.select("subject", "failed", F.array_sort(F.array_distinct("names")).alias("_names"))
    sets = named.select("_names").distinct()
    left = sets.select("_names", F.explode("_names").alias("name")).where("name IS NOT NULL")
    left = left.select("*", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"))
    ok = F.forall(F.array(*[F.lit(c) for c in claims]), lambda c: F.array_contains("claims", c)) if claims else F.lit(True)
    right = entities.where(ok).select("entity", F.explode(F.array_distinct("names")).alias("name"), F.pmod(F.xxhash64("entity"), parts).cast("int").alias("_part")).distinct()
    found = left.join(right, ["name", "_part"]).select("_names", "_part", "entity").distinct()
    agg = found.groupBy("_names", "_part").agg(F.count("*").alias("n"), F.min("entity").alias("entity"))
    agg = agg.groupBy("_names").agg(F.sum("n").alias("n"), F.min("entity").alias("entity"))
    joined = named.join(agg, "_names", "left")
    n = F.coalesce("n", F.lit(0).cast("long"))
    status = F.when(F.col("failed"), "TECHNICAL_FAILURE").when(n == 1, VERIFIED).when(n > 1, AMBIGUOUS).otherwise(UNRESOLVED)
    return joined.select("subject", n.alias("n"), F.when(n == 1, F.col("entity")).alias("entity"), status.alias("status"))


def context_resolve(candidates: DataFrame, subject_clubs: DataFrame, entity_clubs: DataFrame) -> DataFrame:
    """Of (subject, entity) candidates those that share a club; exactly one resolves the subject."""
    shared = candidates.join(subject_clubs, "subject").join(entity_clubs, ["entity", "club"]).select("subject", "entity").distinct()
    agg = shared.groupBy("subject").agg(F.count("*").alias("k"), F.min("entity").alias("e"))
    n = F.coalesce("k", F.lit(0))
    return candidates.select("subject").distinct().join(agg, "subject", "left").select(
        "subject", n.alias("in_context"), F.when(n == 1, F.col("e")).alias("entity"), F.when(n == 1, "RESOLVED").otherwise("AMBIGUOUS").alias("status"))


def choose_statement(statements: DataFrame) -> DataFrame:
    """Preferred statements if a subject has any, else those that are not deprecated.

    No statement is missing, one distinct (time, precision) is verified with the smallest id, more conflict.
    """
    has = statements.groupBy("subject").agg(F.bool_or(F.col("rank") == "preferred").alias("p"))
    usable = statements.join(has, "subject").where(F.when(F.col("p"), F.col("rank") == "preferred").otherwise(F.col("rank") != "deprecated"))
    agg = usable.groupBy("subject").agg(F.count_distinct("time", "precision").alias("n"), F.min_by(F.struct("statement", "time", "precision"), "statement").alias("s"))
    one = F.coalesce("n", F.lit(0)) == 1
    status = F.when(one, VERIFIED).when(F.col("n") > 1, "CONFLICT").otherwise("MISSING")
    joined = has.select("subject").join(agg, "subject", "left")
    return joined.select("subject", status.alias("status"), *[F.when(one, F.col(f"s.{c}")).alias(c) for c in ("statement", "time", "precision")])


def observation_status(http: Column, bound: Column, name: Column, matches: Column, days: Column) -> Column:
    """Why an attempt is or is not accepted, in order of the checks."""
    return (F.when(http == 404, "NOT_FOUND").when(~bound, "NOT_BOUND").when(name.isNull() | (F.trim(name) == ""), "NO_NAME").when(~matches, "NAME_MISMATCH")
            .when(F.size(days) == 0, "NO_DATE").when(F.size(days) > 1, "AMBIGUOUS_DATE").otherwise("ACCEPTED"))


def consensus(subjects: DataFrame, observations: DataFrame, accepted: Column, day: str) -> DataFrame:
    """One distinct accepted day verifies, more conflict, none leaves the subject unresolved."""
    agg = observations.groupBy("subject").agg(
        F.count("*").alias("observations"), F.count_if(accepted).alias("accepted"),
        F.min(F.when(accepted, F.col(day))).alias("_first"), F.max(F.when(accepted, F.col(day))).alias("_last"))
    j = subjects.join(agg, "subject", "left")
    one = F.col("_first") == F.col("_last")
    return j.select("subject", F.coalesce("observations", F.lit(0)).alias("observations"), F.coalesce("accepted", F.lit(0)).alias("accepted"),
                    F.when(one, F.col("_first")).alias("day"), F.when(one, VERIFIED).when(~one, "CONFLICT").otherwise(UNRESOLVED).alias("status"))


def resolve_conflict(observed: Column, existing: Column) -> Column:
    """Only an existing candidate may win, and only if it alone was observed."""
    return (F.when(F.size(observed) == 0, UNRESOLVED).when(F.size(observed) > 1, "CONFLICT_REMAINS")
            .when(F.size(F.array_intersect(observed, existing)) == 1, "RESOLVED").otherwise("NEW_CONFLICT"))


def signature_clusters(rows: DataFrame, group: str, tokens: str, day: str, verified: Column) -> DataFrame:
    """Per provider id: distinct (sorted tokens, day) signatures of its verified rows."""
    sig = F.when(verified, F.concat_ws("|", F.array_join(F.array_sort(tokens), " "), F.col(day)))
    agg = rows.groupBy(group).agg(F.count("*").alias("rows"), F.count_if(verified).alias("verified"), F.count_distinct(sig).alias("signatures"))
    return agg.withColumn("cluster", F.when(F.col("signatures") == 0, "NONE").when(F.col("signatures") == 1, "SINGLE").otherwise("MULTIPLE"))


def cross_scope(rows: DataFrame, entity: str, scope: str, member: str) -> DataFrame:
    """Entities of more than one scope with their number of members."""
    return rows.groupBy(entity).agg(F.count_distinct(scope).alias("scopes"), F.count_distinct(member).alias("members"), F.min(member).alias("first_member")).where("scopes > 1")


def day_dates(statements: DataFrame, time: str, precision: str) -> DataFrame:
    """(subject, days): sorted distinct days of the signed ISO times that are precise to a day (11), joined."""
    day = F.nullif(F.regexp_extract(time, r"^[+]?(\d{4}-\d{2}-\d{2})T", 1), F.lit(""))
    rows = statements.where(F.col(precision) == 11).select("subject", day.alias("_day")).distinct()
    return rows.groupBy("subject").agg(F.array_join(F.array_sort(F.collect_list("_day")), ",").alias("days"))
