"""Counts, pivots, gates and duplicate reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.shared import work_folder


def status_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; null is counted as NULL."""
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("NULL")).alias("status")).agg(F.count("*").alias("n"))


def status_pivot(df: DataFrame, key: str, column: str, values: list[str]) -> DataFrame:
    """One column per listed value, zeros kept; values outside the list are not counted."""
    return df.groupBy(key).agg(*[F.count_if(F.col(column) == v).alias(v.lower()) for v in values])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once with their extra occurrences."""
    return df.groupBy(*keys).agg((F.count("*") - 1).alias("extra")).where("extra > 0")


def duplicate_summary(df: DataFrame, keys: list[str], examples: int = 25) -> DataFrame:
    """One row: keys that occur more than once, their extra occurrences, and the first keys in key order.

    The keys are numbered by a limit that each task applies before it hands on, and the sums ride along
    with the few example rows, so that the duplicates are aggregated once.
    """
    dup = duplicate_keys(df, keys)
    text = F.concat_ws("|", *keys)
    least = F.slice(F.array_sort(F.collect_list(F.struct(*keys, text.alias("t")))), 1, examples)
    # a first aggregate per hash part bounds what a part hands on to its examples
    part = dup.groupBy(F.pmod(F.xxhash64(*keys), F.lit(1024)).alias("_p")).agg(F.count("*").alias("n"), F.sum("extra").alias("e"), least.alias("x"))
    joined = F.slice(F.array_sort(F.flatten(F.collect_list("x"))), 1, examples)
    return part.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("keys"), F.coalesce(F.sum("e"), F.lit(0)).cast("long").alias("extra"),
        F.array_join(F.array_sort(F.transform(joined, lambda x: x["t"])), ",").alias("examples"))


def bounded_examples(df: DataFrame, keys: list[str], order: list[str], value: str, k: int) -> DataFrame:
    """The first k values of every group, joined; the window keeps k rows a group before it shuffles on."""
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    kept = df.withColumn("_k", at).where(F.col("_k") <= k)
    listed = F.array_sort(F.collect_list(F.struct("_k", F.col(value).cast("string").alias("v"))))
    return kept.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x["v"]), ",").alias("examples"))


def coverage(df: DataFrame, fields: list[str], levels: list[list[str]]) -> DataFrame:
    """(level, key, field, observed, records, ratio) at several grouping levels in one aggregation.

    Flags are aggregated as columns and only the small result is unpivoted.
    """
    columns = sorted({c for level in levels for c in level})
    sets = df.groupingSets([[F.col(c) for c in level] for level in levels], *columns)
    wide = sets.agg(F.grouping_id(*columns).alias("_g"), F.count("*").alias("records"), *[F.count(f).alias(f"_{f}") for f in fields])
    bits = {sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in level): level for level in levels}
    names = F.create_map(*[F.lit(x) for g, level in bits.items() for x in (g, "+".join(level) or "all")])
    long = wide.select(
        names[F.col("_g").cast("int")].alias("level"), F.concat_ws("|", *[F.col(c).cast("string") for c in columns]).alias("key"), "records",
        F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_{f}").alias("observed")) for f in fields])).alias("x"),
    )
    return long.select("level", "key", "x.field", "x.observed", "records", (F.col("x.observed") / F.col("records")).alias("ratio"))


def gate(df: DataFrame, ok: Column, threshold: float, min_rows: int) -> DataFrame:
    """One row: expected, ok, ratio, and PASS if both the ratio and the row count reach their bounds."""
    row = df.agg(F.count("*").alias("expected"), F.count_if(ok).alias("ok"))
    ratio = F.when(F.col("expected") > 0, F.col("ok") / F.col("expected"))
    return row.withColumn("ratio", ratio).withColumn(
        "status", F.when((F.coalesce("ratio", F.lit(0.0)) >= threshold) & (F.col("expected") >= min_rows), "PASS").otherwise("FAIL"),
    )


def first_seen(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every key in the given total order."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_k = 1").drop("_k")


def page_manifest(df: DataFrame, scope: list[str], item: str, page: str, order: list[str]) -> DataFrame:
    """Per page: rows, items not seen on an earlier page, and whether the crawl had ended before it.

    The crawl ends at the first page without a new item; later pages are only reported.
    """
    at = F.row_number().over(Window.partitionBy(*scope, item).orderBy(page, *order))
    pages = df.withColumn("_new", (at == 1).cast("int")).groupBy(*scope, page).agg(
        F.count("*").alias("rows"), F.sum("_new").cast("long").alias("new_items"))
    end = F.min(F.when(F.col("new_items") == 0, F.col(page))).over(Window.partitionBy(*scope))
    return pages.withColumn("end_page", end).withColumn("used", F.col("end_page").isNull() | (F.col(page) < F.col("end_page")))


def global_index(df: DataFrame, group: list[str], within: list[str]) -> DataFrame:
    """A gapless global index in (group, within) order without a window over all rows in one task.

    Rows are dealt by ranges of the whole order, so a large group is split as well; they are counted per
    partition, the counts (one row for every shuffle partition) are summed on, and every row adds its place
    in its partition.  Rows that are equal in the whole order get neighbouring numbers in any order.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    where = work_folder(spark, "ranges")
    # written, since another run of a range partitioning may draw other bounds
    df.repartitionByRange(parts, *group, *within).withColumn("_part", F.spark_partition_id()).write.parquet(where)
    rows = spark.read.parquet(where)
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_o"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*group, *within)) - 1
    return rows.withColumn("_p", place).join(starts, "_part").withColumn("global_index", (F.col("_o") + F.col("_p")).cast("long")).drop("_o", "_p", "_part")


def distinct_counts(df: DataFrame, group: list[str], counted: dict[str, list[str]]) -> DataFrame:
    """Distinct values of every named set of columns per group (a null in any of them does not count)."""
    return df.groupBy(*group).agg(*[F.count_distinct(*columns).alias(name) for name, columns in counted.items()])


def distinct_sketches(df: DataFrame, group: list[str], counted: dict[str, list[str]], lg_k: int = 12) -> DataFrame:
    """(group, sketches): a mergeable sketch of the distinct values of every named set of columns, rows with a null in it aside.

    All sketches are made in one pass, without a row for each set; one of ``lg_k`` 12 has 4,096 registers
    and a standard error of about 1.6 %.  Stored for each day, they are united for any range of days.
    """
    def value(columns: list[str]) -> Column:
        return F.when(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]), F.xxhash64(*columns))

    return df.groupBy(*group).agg(*[F.hll_sketch_agg(value(columns), lg_k).alias(name) for name, columns in counted.items()])


def united_counts(sketches: DataFrame, group: list[str], names: list[str]) -> DataFrame:
    """(group, estimates) of ``distinct_sketches`` united over everything else they are kept by."""
    return sketches.groupBy(*group).agg(*[F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in names])


def suffix_counts(df: DataFrame, column: str, pattern: str, filled: Column) -> DataFrame:
    """(provider, rows, non_empty) by the part of a column that ``pattern`` captures."""
    return df.groupBy(F.regexp_extract(column, pattern, 1).alias("provider")).agg(F.count("*").alias("rows"), F.count_if(filled).alias("non_empty"))


def precision_counts(df: DataFrame, precision: str, subject: str) -> DataFrame:
    """Statements per precision with the first subject of each."""
    return df.groupBy(precision).agg(F.count("*").alias("n"), F.min(subject).alias("first_subject"))


def other_precisions(df: DataFrame, precision: str, subject: str, day: int = 11) -> DataFrame:
    """(subject, precision) of every statement that is not of a day, those without a precision included."""
    return df.where(~F.col(precision).eqNullSafe(F.lit(day))).select(subject, precision)


def attempt_counts(df: DataFrame, subject: str, status: str) -> DataFrame:
    """Attempts per subject and status, and (subject null) per status over all, in one aggregation."""
    return df.groupingSets([[F.col(subject), F.col(status)], [F.col(status)]], subject, status).agg(F.count("*").alias("n"))


def repeated_payload(df: DataFrame, sha: str, order: list[str]) -> DataFrame:
    """Add ``duplicate``: whether the payload occurs earlier in the given total order.

    The first place of a payload is an aggregate that is combined before it is shuffled, so a payload
    that many rows share is no window partition.
    """
    first = df.where(F.col(sha).isNotNull()).groupBy(sha).agg(F.min(F.struct(*order)).alias("_first"))
    joined = df.join(first, sha, "left")
    return joined.withColumn("duplicate", F.coalesce(F.struct(*order) > F.col("_first"), F.lit(False))).drop("_first")


def prior_scopes(df: DataFrame, entity: str, scope: str, order: str, keep: int = 5) -> DataFrame:
    """Rows of an entity's next ``keep`` scopes, in order of their first rows, without the first (current) one."""
    first = df.groupBy(entity, scope).agg(F.min(order).alias("_at"))
    place = F.row_number().over(Window.partitionBy(entity).orderBy("_at", scope))
    kept = first.withColumn("_place", place).where(F.col("_place").between(2, keep + 1))
    return df.join(kept.select(entity, scope), [entity, scope], "left_semi")


def pick_leaf(df: DataFrame, keys: list[str], value: Column, order: str, name: str) -> DataFrame:
    """The first leaf of every key in walk order; one with a value replaces one without."""
    best = F.min_by(F.struct(F.col(order), value.alias(name)), F.struct(value.isNull(), F.col(order)))
    return df.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")


def argmax(df: DataFrame, keys: list[str], score: str, fields: list[str]) -> DataFrame:
    """The fields of the row with the largest score per key; of equal ones the first by the fields."""
    best = F.max_by(F.struct(*fields), F.struct(F.col(score), *[-F.col(f) for f in fields]))
    return df.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")


def ordered_distinct(df: DataFrame, key: str, value: str, order: str, name: str) -> DataFrame:
    """Distinct values of a key in order of their first rows, joined; values are combined before they are listed."""
    first = df.groupBy(key, value).agg(F.min(order).alias("_at"))
    listed = F.array_sort(F.collect_list(F.struct("_at", F.col(value).alias("v"))))
    return first.groupBy(key).agg(F.array_join(F.transform(listed, lambda x: x["v"]), ",").alias(name))


def union_aligned(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts; columns that a part lacks are null in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_fields(parts: list[DataFrame]) -> DataFrame:
    """(field): names that the rows of any part have a value for."""
    def names(df: DataFrame) -> DataFrame:
        there = df.agg(*[F.bool_or(F.col(f"`{c}`").isNotNull()).alias(c) for c in df.columns])
        return there.select(F.explode(F.array(*[F.when(F.col(f"`{c}`"), F.lit(c)) for c in df.columns])).alias("field")).where("field IS NOT NULL")

    return reduce(DataFrame.unionByName, [names(p) for p in parts]).distinct()


def common_values(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """(key, common, first) of the keys on both sides: values that both have, and the smallest of them.

    Distinct (key, value) rows meet in a join; no key is collected.
    """
    one, two = left.select(key, value).distinct(), right.select(key, value).distinct()
    keys = one.select(key).distinct().join(two.select(key).distinct(), key, "left_semi")
    both = one.join(two, [key, value], "left_semi").groupBy(key).agg(F.count("*").cast("int").alias("_n"), F.min(value).alias("first"))
    return keys.join(both, key, "left").select(key, F.coalesce("_n", F.lit(0)).alias("common"), "first")


def first_structs(df: DataFrame, fields: list[str], order: str, name: str = "canonical") -> DataFrame:
    """Distinct structs of ``fields`` as JSON with sorted keys, and the first row's ``order`` of each."""
    return df.groupBy(F.to_json(F.struct(*sorted(fields)), {"ignoreNullFields": "false"}).alias(name)).agg(F.min(order).alias("first"))


def locale_position(df: DataFrame, group: list[str], name: str, tie: str) -> DataFrame:
    """Add ``position``: place in its group by the name in language order."""
    return df.withColumn("position", F.row_number().over(Window.partitionBy(*group).orderBy(F.collate(name, "UNICODE"), tie)))


def new_rows(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows of ``new`` without those of ``old``, each as often as it is surplus; nulls are equal."""
    return new.exceptAll(old.select(*new.columns))
