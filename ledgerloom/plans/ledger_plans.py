"""Match-ledger queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import ledger
from .common import MATCHES, STANDINGS, matches, table

_SIDES = "l_orderkey, l_linenumber, l_suppkey % 20 AS h, (l_partkey + 7) % 20 AS a, l_linenumber % 4 AS k"


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """Ledger lines in both layouts, with clocks, brackets, tags and uneven white space; comments and cancelled matches between."""
    sides = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_suppkey % 20 AS h", "(l_partkey + 7) % 20 AS a", "l_linenumber % 4 AS k",
                                                    "cast(l_quantity AS long) % 5 AS g")
    return sides.selectExpr(
        "l_orderkey AS file_id", "l_linenumber AS line_no",
        """CASE l_linenumber % 5
             WHEN 0 THEN concat('20:45  Team  ', h, ' v Team ', a, '  ', g, '-', k, if(h % 2 = 0, ' (0-0)', ' (aet)'))
             WHEN 1 THEN concat('  Team ', h, '  ', g, '-', k, if(a % 2 = 0, ' (1-0)', ''), '  Team   ', a, ' ')
             WHEN 2 THEN concat('Team ', h, ' v Team ', a, '  [cancelled]')
             WHEN 3 THEN concat('Team ', h, ' V Team ', a, ' ', g, '-', k, if(a % 3 = 0, ' [awarded]', ' [replay]'))
             ELSE concat('# Team ', h, ' 3-1') END AS line""",
    )


def standings(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.standings(matches(spark, sf))


def _with_percentile(df: DataFrame) -> DataFrame:
    return ledger.tie_averaged_percentile(df, ledger.GROUP, "points_per_game", "ppg_percentile")


def ppg_percentile(spark: SparkSession, sf: str) -> DataFrame:
    return _with_percentile(standings(spark, sf)).select("season", "competition", "team", "points", "ppg_percentile")


def ppg_percentile_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Coarse points per game, so that many teams tie."""
    coarse = standings(spark, sf).withColumn("points_per_game", F.floor(F.col("points_per_game") * 10) / 10)
    return _with_percentile(coarse).select("season", "competition", "team", "ppg_percentile")


def group_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Declared sizes are missing for every third and fourth year and off by one in others."""
    sizes = standings(spark, sf).groupBy(*ledger.GROUP).agg(F.count("*").alias("t"), F.sum("played").alias("p")).selectExpr(
        *ledger.GROUP, "if(season % 3 = 0, NULL, t + season % 2) AS declared_teams", "if(season % 4 = 0, NULL, p DIV 2 + if(season % 5 = 0, 1, 0)) AS expected_matches")
    return ledger.audit_groups(_with_percentile(standings(spark, sf)), expected=sizes)


def sort_standings(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.positions(standings(spark, sf))


def match_line_parse(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.parse_match_lines(_lines(spark, sf)).drop("line")


def regular_season_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    limited = matches(spark, sf).withColumn("limit", F.when(F.col("file_id") % 5 != 0, F.col("file_id") % 4))
    # the SQL leaves the order of rows open that agree in the first four; here the rest decides, so that every run gives the same
    order = ["line_no", "home", "away", "home_goals", "away_goals", "season", "competition"]
    return ledger.regular_season(limited, ["file_id"], order, "limit").groupBy("season", "competition").agg(
        F.count("*").alias("matches"), F.sum("home_goals").alias("home_goals"),
    )


def header_numbers(spark: SparkSession, sf: str) -> DataFrame:
    files = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS file_id",
        r"""concat(
          if(o_orderkey % 3 = 0, '', concat(if(o_orderkey % 2 = 0, '# Teams   ', '#Team '), o_custkey % 24, '\n')), '= League\r\n',
          if(o_orderkey % 4 = 0, '# Matches unknown\n', concat('# matches  ', o_orderkey % 400, ' \r\n')),
          if(o_orderkey % 5 = 0, concat('# Stages  Regular Season (', o_custkey % 90, ')  Final (1)\n'), '  Regular Season (12)\n'), 'A v B 1-0') AS body""",
    )
    return ledger.header_numbers(files).drop("body")


def season_labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_orderkey", ledger.season_label(F.year("o_orderdate")).alias("label"))
    slashed = F.concat(F.substring("label", 1, 4), F.lit("/"), F.substring("label", 6, 2))
    return rows.select("o_orderkey", "label", ledger.season_start("label").alias("snapshot_year"), ledger.season_slug(slashed).alias("slug"))


def guarded_supplement(spark: SparkSession, sf: str) -> DataFrame:
    ledger_rows = matches(spark, sf)
    expected = ledger_rows.groupBy("season", "competition").agg(
        (F.count("*") + F.when(F.col("competition") == "A", 0).otherwise(3)).alias("expected_matches"))
    teams = table(spark, sf, "nation").crossJoin(expected.select("season", "competition"))
    there = ledger_rows.groupBy("season", "competition").agg(F.min(F.struct("home", "away", "home_goals", "away_goals")).alias("m"))
    new = teams.selectExpr(
        "season", "competition", "concat('New ', n_name) AS home", "'Team 1' AS away", "cast(n_nationkey AS long) % 3 AS home_goals", "1L AS away_goals",
        "array(n_name, '1') AS evidence_tokens", "concat('<b>', if(n_nationkey % 2 = 0, lower(n_name), 'x'), '</b> 1') AS evidence",
    )
    old = there.selectExpr("season", "competition", "m.home", "m.away", "m.home_goals", "m.away_goals", "array('x') AS evidence_tokens", "'x' AS evidence")
    return ledger.guarded_supplement(ledger_rows, new.unionByName(old), expected).groupBy("season", "competition", "status").agg(F.count("*").alias("n"))


QUERIES = {
    "standings": (standings, f"WITH {STANDINGS} SELECT * FROM standings"),
    "ppg_percentile": (ppg_percentile, f"WITH {STANDINGS} SELECT season, competition, team, points, ppg_percentile FROM pct"),
    "ppg_percentile_ties": (ppg_percentile_ties, "WITH " + STANDINGS.replace(
        "(3 * wins + draws) / played AS points_per_game", "floor((3 * wins + draws) / played * 10) / 10 AS points_per_game")
        + " SELECT season, competition, team, ppg_percentile FROM pct"),
    "group_audit": (group_audit, f"""WITH {STANDINGS}, a AS (
      SELECT season, competition, count(*) AS teams, (sum(played) / 2)::BIGINT AS matches, min(played) <> max(played) AS unequal,
        sum(goals_for) <> sum(goals_against) AS goals, bool_or(wins + draws + losses <> played) AS res, bool_or(points <> 3 * wins + draws) AS pts,
        coalesce(bool_or(ppg_percentile IS NULL), false) AS fin, coalesce(bool_or(ppg_percentile NOT BETWEEN 0 AND 1), false) AS rng FROM pct GROUP BY ALL),
      f AS (SELECT *, array_to_string(list_filter([CASE WHEN season % 3 = 0 THEN 'missing_header_teams' END, CASE WHEN season % 4 = 0 THEN 'missing_expected_match_count' END,
        CASE WHEN season % 3 <> 0 AND season % 2 = 1 THEN 'team_count_mismatch' END, CASE WHEN season % 4 <> 0 AND season % 5 = 0 THEN 'match_count_mismatch' END,
        CASE WHEN unequal THEN 'unequal_games_played' END, CASE WHEN goals THEN 'goals_balance_mismatch' END, CASE WHEN res THEN 'wdl_algebra_mismatch' END,
        CASE WHEN pts THEN 'points_algebra_mismatch' END, CASE WHEN fin THEN 'nonfinite_metric' END, CASE WHEN rng THEN 'percentile_out_of_range' END],
        lambda x: x IS NOT NULL), ',') AS failures FROM a)
      SELECT season, competition, teams, matches, failures, CASE WHEN failures = '' THEN 'PASS' ELSE 'FAIL' END AS status FROM f"""),
    "sort_standings": (sort_standings, f"""WITH {STANDINGS} SELECT season, competition, team, row_number() OVER (PARTITION BY season, competition
      ORDER BY points_per_game DESC, goal_difference_per_game DESC, team)::INTEGER AS position FROM standings"""),
    "match_line_parse": (match_line_parse, f"""WITH s AS (SELECT {_SIDES}, l_quantity::BIGINT % 5 AS g FROM lineitem)
      SELECT l_orderkey AS file_id, l_linenumber AS line_no, 'Team ' || h AS home, 'Team ' || a AS away, g AS home_goals, k::BIGINT AS away_goals,
        CASE WHEN l_linenumber % 5 = 3 AND a % 3 = 0 THEN 'awarded' END AS annotation FROM s WHERE l_linenumber % 5 IN (0, 1, 3) AND h <> a"""),
    "regular_season_cutoff": (regular_season_cutoff, f"""WITH {MATCHES}, r AS (SELECT *, CASE WHEN file_id % 5 <> 0 THEN file_id % 4 END AS lim,
      row_number() OVER (PARTITION BY file_id ORDER BY line_no, home, away, home_goals) AS k FROM matches)
      SELECT season, competition, count(*) AS matches, sum(home_goals)::BIGINT AS home_goals FROM r WHERE lim IS NULL OR k <= lim GROUP BY ALL"""),
    "header_numbers": (header_numbers, """SELECT o_orderkey AS file_id, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey % 24 END AS declared_teams,
      CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 400 END AS declared_matches, CASE WHEN o_orderkey % 5 = 0 THEN o_custkey % 90 END AS regular_matches,
      CASE WHEN o_orderkey % 5 = 0 THEN o_custkey % 90 WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 400 END AS expected_matches FROM orders"""),
    "season_labels": (season_labels, """SELECT o_orderkey, (year(o_orderdate) - 1) || '-' || lpad((year(o_orderdate) % 100)::VARCHAR, 2, '0') AS label,
      (year(o_orderdate) - 1)::INTEGER AS snapshot_year, (year(o_orderdate) - 1) || '-' || lpad((year(o_orderdate) % 100)::VARCHAR, 2, '0') AS slug FROM orders"""),
    "guarded_supplement": (guarded_supplement, f"""WITH {MATCHES}, c AS (SELECT season, competition, count(*) AS n FROM matches GROUP BY ALL),
      x AS (SELECT season, competition, CASE WHEN competition = 'A' THEN 'group_full' WHEN n_nationkey % 2 = 0 THEN 'applied' ELSE 'evidence_missing' END AS status
        FROM c, nation UNION ALL SELECT season, competition, 'already_present' FROM c)
      SELECT season, competition, status, count(*) AS n FROM x GROUP BY ALL"""),
}
