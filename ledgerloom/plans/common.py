"""Tables and shared derivations for the query plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt to some tasks a core by ``keys``: a small table is often one row group of one file, so one task, whatever its rows cost later."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *keys)


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A match ledger made of order lines: season, competition, teams, goals; no self-matches."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "year(l_shipdate) AS season", "l_returnflag AS competition", "l_orderkey AS file_id", "l_linenumber AS line_no",
        "concat('Team ', l_suppkey % 20) AS home", "concat('Team ', (l_partkey + 7) % 20) AS away",
        "cast(l_quantity AS long) % 5 AS home_goals", "cast(l_linenumber AS long) % 4 AS away_goals",
    ).where(F.col("home") != F.col("away"))


MATCHES = """matches AS (
  SELECT year(l_shipdate)::INTEGER AS season, l_returnflag AS competition, l_orderkey AS file_id, l_linenumber AS line_no,
    'Team ' || (l_suppkey % 20) AS home, 'Team ' || ((l_partkey + 7) % 20) AS away,
    l_quantity::BIGINT % 5 AS home_goals, l_linenumber::BIGINT % 4 AS away_goals
  FROM lineitem WHERE l_suppkey % 20 <> (l_partkey + 7) % 20)"""

STANDINGS = MATCHES + """,
sides AS (
  SELECT season, competition, home AS team, home_goals AS gf, away_goals AS ga FROM matches
  UNION ALL SELECT season, competition, away, away_goals, home_goals FROM matches),
tab AS (
  SELECT season, competition, team, count(*) AS played, count(*) FILTER (gf > ga) AS wins, count(*) FILTER (gf = ga) AS draws,
    count(*) FILTER (gf < ga) AS losses, sum(gf)::BIGINT AS goals_for, sum(ga)::BIGINT AS goals_against
  FROM sides GROUP BY ALL),
standings AS (
  SELECT *, goals_for - goals_against AS goal_difference, 3 * wins + draws AS points,
    (3 * wins + draws) / played AS points_per_game, (goals_for - goals_against) / played AS goal_difference_per_game
  FROM tab),
ranked AS (
  SELECT *, count(*) OVER g AS n, rank() OVER (PARTITION BY season, competition ORDER BY round(points_per_game, 12) DESC)
    - 1 + (count(*) OVER (PARTITION BY season, competition, round(points_per_game, 12)) - 1) / 2.0 AS place
  FROM standings WINDOW g AS (PARTITION BY season, competition)),
pct AS (SELECT * EXCLUDE (n, place), CASE WHEN n > 1 THEN ((n - 1 - place) / (n - 1))::DOUBLE END AS ppg_percentile FROM ranked)"""
