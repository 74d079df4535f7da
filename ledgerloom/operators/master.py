"""Identity master: override precedence, person keys, rollup, provider units, registry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apply_overrides(base: DataFrame, sources: list[DataFrame]) -> DataFrame:
    """(subject, status, day, origin): a later source wins, then the first pass, else UNACCOUNTED.

    An override without a day still decides: it sets its status.
    """
    ranked = reduce(DataFrame.unionByName, [s.select("subject", "status", "day", F.lit(i).alias("p")) for i, s in enumerate(sources, 1)])
    best = ranked.groupBy("subject").agg(F.max_by(F.struct("status", "day", "p"), "p").alias("o"))
    j = base.select("subject", F.col("status").alias("s0"), F.col("day").alias("d0")).join(best, "subject", "left")
    over = F.col("o").isNotNull()
    return j.select(
        "subject", F.when(over, F.col("o.status")).otherwise(F.coalesce("s0", F.lit("UNACCOUNTED"))).alias("status"),
        F.when(over, F.col("o.day")).otherwise(F.col("d0")).alias("day"), F.when(over, F.col("o.p")).otherwise(F.lit(0)).alias("origin"))


def person_keys(current: DataFrame, historical: DataFrame) -> DataFrame:
    """Current subject -> person: bridge, else an entity that exactly one historical person owns, else the
    entity, else the subject's own key."""
    owned = historical.where("entity IS NOT NULL").groupBy("entity").agg(F.count_distinct("person").alias("n"), F.min("person").alias("owner")).where("n = 1").drop("n")
    j = current.join(owned, "entity", "left")
    key = F.coalesce("bridge", "owner", F.concat(F.lit("entity:"), "entity"), F.concat(F.lit("self:"), "subject"))
    how = F.when(F.col("bridge").isNotNull(), "BRIDGE").when(F.col("owner").isNotNull(), "UNIQUE_ENTITY").when(F.col("entity").isNotNull(), "ENTITY").otherwise("OWN")
    return j.select("subject", key.alias("person"), how.alias("method"))


#: Kinds of what is known of a person, and the fields of each; missing ones are null.
KINDS = {
    "scope": ("scope",), "name": ("name",), "ref": ("scope", "subject", "method", "source_status"), "alias": ("provider", "provider_id", "scope"),
    "evidence": ("scope", "subject", "status", "day", "method"),
}
_FIELDS = tuple(dict.fromkeys(f for fields in KINDS.values() for f in fields))
PART_ROWS = 1000


def person_facts(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """(person, kind, fields, seq): every distinct fact of a person once, with the first place where it stands.

    ``rows`` has (person, seq, scope, subject, name, method, source_status, status, day, dob_method), ``aliases``
    (person, seq, provider, provider_id, scope); ``seq`` is any orderable place.  Equal facts meet by all
    their fields, after a partial aggregate in each task, so a person of many rows is no single task's work.
    """
    source = {"name": rows.where("name <> ''"), "alias": aliases.where("provider_id IS NOT NULL")}
    renamed = {("evidence", "method"): "dob_method"}
    parts = []
    for kind, fields in KINDS.items():
        df = source.get(kind, rows)
        cols = [(F.col(renamed.get((kind, f), f)).cast("string") if f in fields else F.lit(None).cast("string")).alias(f) for f in _FIELDS]
        parts.append(df.select("person", F.lit(kind).alias("kind"), *cols, "seq"))
    return reduce(DataFrame.unionByName, parts).groupBy("person", "kind", *_FIELDS).agg(F.min("seq").alias("seq"))


def identity_master(facts: DataFrame) -> DataFrame:
    """One row a person of ``person_facts``: (person, scopes, subjects, names, aliases, evidence, first_name, status, day).

    Counts of distinct facts, the name that stands first, and the decision: one conflicting fact makes the
    person a conflict; distinct verified days are an error; one day verifies; none is missing.
    """
    def n(kind: str) -> Column:
        return F.count_if(F.col("kind") == kind)

    day = F.when((F.col("kind") == "evidence") & (F.col("status") == "VERIFIED"), F.col("day"))
    named = F.when(F.col("kind") == "name", F.struct("seq", "name"))
    agg = facts.groupBy("person").agg(
        n("scope").alias("scopes"), n("ref").alias("subjects"), n("name").alias("names"), n("alias").alias("aliases"), n("evidence").alias("evidence"),
        F.min(named).alias("_name"), F.bool_or((F.col("kind") == "evidence") & F.coalesce(F.col("status") == "CONFLICT", F.lit(False))).alias("_conflict"), F.min(day).alias("_first"), F.max(day).alias("_last"))
    status = F.when(F.col("_conflict"), "CONFLICT").when(F.col("_first") != F.col("_last"), "ERROR").when(F.col("_first").isNotNull(), "VERIFIED").otherwise("MISSING")
    return agg.select("person", "scopes", "subjects", "names", "aliases", "evidence", F.col("_name.name").alias("first_name"), status.alias("status"),
                      F.when(status == "VERIFIED", F.col("_first")).alias("day"))


def person_documents(facts: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(person, part, parts, scope, name, ref, alias, evidence): the facts of a person as lists of structs in first-seen order.

    A person with more than ``part_rows`` facts gets several parts, dealt by a hash of the fact, so no row
    grows with the table; each fact keeps its ``seq``, by which the parts' lists are one list again.
    """
    sizes = facts.groupBy("person").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts"))
    dealt = facts.join(sizes, "person").withColumn("part", F.pmod(F.xxhash64("kind", *_FIELDS), F.col("parts")).cast("int"))
    listed = dealt.groupBy("person", "part", "parts").agg(F.array_sort(F.collect_list(F.struct("seq", "kind", *_FIELDS))).alias("_f"))

    def of(kind: str, fields: tuple[str, ...]) -> Column:
        own = F.filter("_f", lambda x: x["kind"] == kind)
        return F.transform(own, lambda x: F.struct(*[x[f].alias(f) for f in (*fields, "seq")])).alias(kind)

    return listed.select("person", "part", "parts", *[of(kind, fields) for kind, fields in KINDS.items()])


def provider_units(rows: DataFrame, unit: str, name: str, day: str, prefix: str) -> DataFrame:
    """Units that never merge into persons: a single day is required, several names of one day are told."""
    agg = rows.groupBy(unit).agg(F.count_distinct(day).alias("days"), F.count_distinct(name).alias("names"), F.min(day).alias("first"))
    status = F.when(F.col("days") != 1, "NO_CONSENSUS").when(F.col("names") > 1, "MULTIPLE_NAMES_SAME_DATE").otherwise("SINGLE")
    key = F.concat(F.lit(prefix), F.substring(F.sha2(F.col(unit).cast("string"), 256), 1, 24))
    return agg.select(unit, key.alias("unit_key"), "names", status.alias("status"), F.when(F.col("days") == 1, F.col("first")).alias("day"))


def registry_counts(parts: dict[str, DataFrame], status: str = "status") -> DataFrame:
    """(scope, status, n) over several result tables."""
    rows = [df.groupBy(F.lit(k).alias("scope"), F.col(status).alias("status")).agg(F.count("*").alias("n")) for k, df in parts.items()]
    return reduce(DataFrame.unionByName, rows)


def registry_residuals(parts: dict[str, tuple[DataFrame, str, list[str]]], status: str = "status") -> DataFrame:
    """(scope, status, key): the rows of each table, by their key column, whose status is one of the open ones."""
    rows = [df.where(F.col(status).isin(open_)).select(F.lit(k).alias("scope"), F.col(status).alias("status"), F.col(key).cast("string").alias("key")) for k, (df, key, open_) in parts.items()]
    return reduce(DataFrame.unionByName, rows)
