"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Link every vertex's larger (large) or smaller (small) neighbours to its smallest one."""
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = around.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u <> v").dropDuplicates()


def components(edges: DataFrame, scratch: Scratch, name: str = "edges", max_rounds: int = 60) -> DataFrame:
    """(u, component): the smallest vertex reachable from every vertex that has an edge.

    ``edges`` has long columns u and v; loops and repeated edges do no harm.  Every round is written
    to the shared folder; only a row count and a checksum come to the driver.
    """
    oriented = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).dropDuplicates()
    now = scratch.write(oriented, f"{name}0")
    before = _state(now)
    for r in range(1, max_rounds + 1):
        # both halves of a round are one plan; the written table cuts its lineage
        now = scratch.write(_stars(_stars(now, True), False), f"{name}{r}")
        state = _state(now)
        scratch.drop(f"{name}{r - 1}")
        if state == before:  # stars to the smallest vertex stay as they are
            return now.groupBy("u").agg(F.min("v").alias("component"))
        before = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first())
