"""Yearly coefficient snapshots: floors, component sums, ranks with ties, named checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPSILON = 1e-9


def with_floor(df: DataFrame, points: str, floor: str) -> DataFrame:
    """coefficient = max(points, floor); the flag says that the floor decided (not on equality)."""
    return df.withColumn("coefficient", F.greatest(points, floor)).withColumn(
        "uses_floor", F.col(floor) > F.col(points) + F.lit(EPSILON),
    )


def component_sum(df: DataFrame, components: list[str], total: str, unit: float) -> DataFrame:
    """Missing components count as 0 but shrink the tolerance ``unit`` * n + 1e-9."""
    parts = F.array(*[F.col(c).cast("double") for c in components])
    n = F.size(F.filter(parts, lambda x: x.isNotNull()))
    value = F.aggregate(parts, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    return df.withColumn("n_components", n).withColumn("component_sum", value).withColumn(
        "within", F.abs(value - F.col(total)) <= F.lit(unit) * n + F.lit(EPSILON),
    )


def rank_with_ties(df: DataFrame, keys: list[str], value: str, name: str = "rank", digits: int = 9) -> DataFrame:
    """1, 1, 3 per group by ``value`` descending; values that agree to ``digits`` decimals tie."""
    order = Window.partitionBy(*keys).orderBy(F.round(F.col(value), digits).desc_nulls_last())
    return df.withColumn(name, F.rank().over(order))


def rank_by_gap(df: DataFrame, keys: list[str], value: str, order: list[str], name: str = "rank", gap: float = EPSILON) -> DataFrame:
    """Like ``rank_with_ties``, but a row ties with the row before it when they differ by at most ``gap``."""
    by = Window.partitionBy(*keys).orderBy(F.desc(value), *order)
    new = F.coalesce(F.lag(value).over(by) - F.col(value) > gap, F.lit(True))
    place = F.row_number().over(by)
    return df.select("*", F.when(new, place).alias("_start")).withColumn(
        name, F.max("_start").over(by.rowsBetween(Window.unboundedPreceding, 0)),
    ).drop("_start")


def out_of_order(df: DataFrame, keys: list[str], position: str, value: str) -> DataFrame:
    """Rows whose value exceeds that of the row before them."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(position))
    return df.withColumn("before", before).where(F.col(value) > F.col("before"))


def named_checks(df: DataFrame, keys: list[str], checks: dict[str, Column]) -> DataFrame:
    """Long table (keys, check, passed) of one aggregated condition per name."""
    wide = df.groupBy(*keys).agg(*[c.alias(name) for name, c in checks.items()])
    return reduce(DataFrame.unionByName, [
        wide.select(*keys, F.lit(name).alias("check"), F.coalesce(F.col(name), F.lit(False)).alias("passed")) for name in checks
    ])


def crosscheck_top(df: DataFrame, expected: DataFrame, keys: list[str], name: str, value: str, rank: str, gap: float = EPSILON) -> DataFrame:
    """Per group: whether every expected (rank, name, value) is what the snapshot has there."""
    got = df.select(*keys, rank, F.col(name).alias("_name"), F.col(value).alias("_value"))
    same = F.coalesce((F.col("_name") == F.col(name)) & (F.abs(F.col("_value") - F.col(value)) <= gap), F.lit(False))
    return expected.join(got, [*keys, rank], "left").groupBy(*keys).agg(F.count("*").alias("expected"), F.bool_and(same).alias("passed"))


def parse_cells(df: DataFrame, cells: str = "cells", tail: int = 7) -> DataFrame:
    """club, association and the numbers of a table row given as an array of cell texts.

    The association is the cell with two capital letters and digits left of the last ``tail`` cells,
    the club the cell before it; short rows and rows with a non-numeric total go.  Empty components
    are null.
    """
    c = F.col(cells)
    where = F.array_position(F.transform(c, lambda x: x.rlike("^[A-Z]{3}$")), True).cast("int")
    numbers = F.transform(F.slice(c, F.size(c) - (tail - 1), F.lit(tail)), strict_number)
    row = df.where((F.size(c) >= tail + 2) & (where > 1)).select(
        *[x for x in df.columns if x != cells], c[where - 2].alias("club"), c[where - 1].alias("association"), numbers.alias("_n"),
    )
    named = [F.col("_n")[i].alias(f"s{i + 1}") for i in range(tail - 2)]
    out = row.select("*", *named, F.col("_n")[tail - 2].alias("points"), F.col("_n")[tail - 1].alias("floor")).drop("_n")
    return out.where("points IS NOT NULL AND floor IS NOT NULL")


def strict_number(text: Column) -> Column:
    """A number without thousands commas; anything but -?digits(.digits)? is null."""
    plain = F.regexp_replace(F.trim(text), ",", "")
    return F.when(plain.rlike(r"^-?\d+(\.\d+)?$"), plain.cast("double"))


def number_or_zero(text: Column) -> Column:
    """Lenient: what is no finite number is 0."""
    value = text.try_cast("double")
    return F.when(value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")), 0.0).otherwise(value)
