"""Match ledgers: text lines to matches, matches to audited league standings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUP = ("season", "competition")


def explode_lines(files: DataFrame, body: str = "body") -> DataFrame:
    """One row per line of every file with ``line_no`` from 1; CRLF endings count as line ends."""
    return files.select(
        *[c for c in files.columns if c != body], F.posexplode(F.split(body, r"\r?\n")).alias("line_no", "line"),
    ).withColumn("line_no", F.col("line_no") + 1)


def parse_match_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add home, away, home_goals, away_goals, annotation; lines that are no match go.

    Two layouts: ``home v away 2-1 (1-0) [awarded]`` and ``home 2-1 (1-0) away``, both with an optional
    kick-off time in front; any bracket may follow the score, and white space inside names collapses.  A
    line with `` v `` but no score at its end is a cancelled match and is never read in the other layout,
    which in turn has no awarded matches.  Self-matches go, and scores that pass 64 bits are none.
    """
    plain = F.regexp_replace(F.trim(F.regexp_replace(line, r"\s+", " ")), r"^\d{1,2}[:.]\d{2} ", "")
    step = lines.select("*", plain.alias("_text"))

    # layout with a "v": peel off the tag and the bracket, then the score is the last word
    ended = F.regexp_replace(F.regexp_replace("_text", r" ?\[[^\]]+\]$", ""), r" ?\([^)]*\)$", "")
    # layout without: the first score between two words parts the line
    parts = F.split("_text", r" \d+-\d+ ", 2)
    step = step.select("*", (F.instr(F.lower("_text"), " v ") > 0).alias("_versus"), ended.alias("_ended"), parts.alias("_parts"))

    size, word = F.length, F.col
    last = F.substring_index("_ended", " ", -1)
    home, rest = F.get("_parts", F.lit(0)), F.get("_parts", F.lit(1))
    score = F.when(word("_versus"), last).when(F.size("_parts") == 2, F.substring("_text", size(home) + 2, size("_text") - size(home) - size(rest) - 2))
    names = F.when(word("_versus"), F.substring("_ended", F.lit(1), size("_ended") - size(last) - 1))
    step = step.select("*", score.alias("_score"), names.alias("_names"), F.regexp_replace(rest, r"^\([^)]*\) ", "").alias("_rest"), home.alias("_home"))

    at = F.instr(F.lower("_names"), " v ")
    first = F.when(word("_versus"), F.when(at > 0, F.substring("_names", F.lit(1), at - 1))).otherwise(word("_home"))
    second = F.when(word("_versus"), F.when(at > 0, F.substring("_names", at + 3, size("_names")))).otherwise(word("_rest"))
    step = step.select("*", F.trim(first).alias("_first"), F.trim(second).alias("_second"), F.contains(F.lower("_text"), F.lit("[awarded]")).alias("_awarded"))

    goals = [F.when(word("_score").rlike(r"^[0-9]+-[0-9]+$"), F.substring_index("_score", "-", side)).try_cast("long") for side in (1, -1)]
    good = (
        goals[0].isNotNull() & goals[1].isNotNull() & (word("_first") != "") & (word("_second") != "") & (word("_first") != word("_second"))
        & (word("_versus") | ~word("_awarded"))
    )
    found = F.struct(
        word("_first").alias("home"), word("_second").alias("away"), goals[0].alias("home_goals"), goals[1].alias("away_goals"),
        F.when(word("_awarded"), "awarded").alias("annotation"),
    )
    # a generator, so that the fields are not evaluated again for a filter
    return step.select(*lines.columns, F.inline(F.when(good, F.array(found))))


def header_numbers(files: DataFrame, body: str = "body") -> DataFrame:
    """Numbers that a file's ``#`` lines declare: teams, matches and regular-season matches; null where missing or beyond 64 bits.

    ``# Teams 18`` or ``# Team 18``, the same for matches; the regular season is read from the stage
    line alone (``# Stages  Regular Season (306) ...``).  ``expected_matches`` falls back to all matches.
    """
    comments = F.filter(F.split(body, r"\r?\n"), lambda x: F.startswith(x, F.lit("#")))
    entries = F.transform(comments, lambda x: F.lower(F.trim(F.regexp_replace(F.substring(x, F.lit(2), F.length(x)), r"\s+", " "))))
    read = files.select("*", entries.alias("_entries"))

    def values(*labels: str) -> Column:
        named = F.filter("_entries", lambda x: F.substring_index(x, " ", 1).isin(*labels))
        return F.transform(named, lambda x: F.substring(x, F.instr(x, " ") + 1, F.length(x)))

    def number(*labels: str) -> Column:
        return F.get(F.filter(F.transform(values(*labels), lambda x: F.when(x.rlike(r"^[0-9]+$"), x).try_cast("long")), lambda x: x.isNotNull()), F.lit(0))

    stages = F.transform(values("stage", "stages"), lambda x: F.regexp_extract(x, r"regular season ?\((\d+)\)", 1))
    return read.select(
        *files.columns, number("team", "teams").alias("declared_teams"), number("match", "matches").alias("declared_matches"),
        F.get(F.filter(F.transform(stages, lambda x: F.nullif(x, F.lit("")).try_cast("long")), lambda x: x.isNotNull()), F.lit(0)).alias("regular_matches"),
    ).withColumn("expected_matches", F.coalesce("regular_matches", "declared_matches"))


def season_label(end_year: Column) -> Column:
    """``YYYY-YY`` of the season that ends in a year."""
    return F.concat((end_year - 1).cast("string"), F.lit("-"), F.lpad((end_year % 100).cast("string"), 2, "0"))


def season_start(label: str) -> Column:
    """First year of a ``YYYY-YY`` label, null for any other text."""
    return F.when(F.col(label).rlike(r"^\d{4}-\d{2}$"), F.substring(label, 1, 4).cast("int"))


def season_slug(label: Column) -> Column:
    """``YYYY/YY`` as it stands in paths, ``YYYY-YY``."""
    return F.translate(label, "/", "-")


def regular_season(matches: DataFrame, keys: list[str], order: list[str], limit: str) -> DataFrame:
    """The first ``limit`` parsed rows of every file, by ``order`` with nulls last; a file without a declared limit keeps all."""
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*map(F.asc_nulls_last, order)))
    return matches.withColumn("_n", at).where(F.col(limit).isNull() | (F.col("_n") <= F.col(limit))).drop("_n")


def positions(table: DataFrame, keys: tuple[str, ...] = GROUP) -> DataFrame:
    """(keys, team, position): best points per game, then goal difference per game, then team in dictionary order, whatever its accents and case."""
    order = Window.partitionBy(*keys).orderBy(F.desc("points_per_game"), F.desc("goal_difference_per_game"), F.collate("team", "UNICODE"), "team")
    return table.select(*keys, "team", F.row_number().over(order).alias("position"))


def standings(matches: DataFrame, keys: tuple[str, ...] = GROUP) -> DataFrame:
    """Table rows per team: P, W, D, L, goals, points (3/1/0) and per-game ratios."""
    sides = matches.select(*keys, F.explode(F.array(
        F.struct(F.col("home").alias("team"), F.col("home_goals").alias("gf"), F.col("away_goals").alias("ga")),
        F.struct(F.col("away").alias("team"), F.col("away_goals").alias("gf"), F.col("home_goals").alias("ga")),
    )).alias("s")).select(*keys, "s.*")
    won, drawn, lost = (F.count_if(c) for c in (F.col("gf") > F.col("ga"), F.col("gf") == F.col("ga"), F.col("gf") < F.col("ga")))
    table = sides.groupBy(*keys, "team").agg(
        F.count("*").alias("played"), won.alias("wins"), drawn.alias("draws"), lost.alias("losses"),
        F.sum("gf").cast("long").alias("goals_for"), F.sum("ga").cast("long").alias("goals_against"),
    )
    points, diff = F.col("wins") * 3 + F.col("draws"), F.col("goals_for") - F.col("goals_against")
    return table.select(
        "*", diff.alias("goal_difference"), points.alias("points"), (points / F.col("played")).alias("points_per_game"),
        (diff / F.col("played")).alias("goal_difference_per_game"),
    )


def tie_averaged_percentile(df: DataFrame, keys: tuple[str, ...], value: str, name: str) -> DataFrame:
    """1 for the top, 0 for the bottom, ties share their average place; null in a group of one.

    Values tie when they agree to 12 decimals.
    """
    exact = F.round(F.col(value), 12)
    group = Window.partitionBy(*keys)
    n = F.count("*").over(group)
    ties = F.count("*").over(Window.partitionBy(*keys, exact))
    place = F.rank().over(group.orderBy(exact.desc())) - 1 + (ties - 1) / F.lit(2.0)
    return df.withColumn(name, F.when(n > 1, (n - 1 - place) / (n - 1)))


# Failure codes of a group audit, in the order in which they are listed.
FAILURES = [
    "missing_header_teams", "missing_expected_match_count", "team_count_mismatch", "match_count_mismatch", "unequal_games_played",
    "goals_balance_mismatch", "wdl_algebra_mismatch", "points_algebra_mismatch", "nonfinite_metric", "percentile_out_of_range",
]


def audit_groups(table: DataFrame, keys: tuple[str, ...] = GROUP, percentile: str = "ppg_percentile", expected: DataFrame | None = None) -> DataFrame:
    """Per group: teams, matches, its failure codes and PASS or FAIL.

    ``expected`` has declared_teams and expected_matches per group; a group without a row there, or with a
    null, lacks its header.  Without ``expected`` sizes are not checked.
    """
    def any_row(condition: Column) -> Column:
        return F.coalesce(F.bool_or(condition), F.lit(False))

    def finite(name: str) -> Column:
        return F.coalesce(F.abs(F.col(name)) < float("inf"), F.lit(False)) & ~F.isnan(F.col(name))

    metrics = ("points_per_game", "goal_difference_per_game", percentile)
    agg = table.groupBy(*keys).agg(
        F.count("*").alias("teams"), (F.sum("played") / 2).cast("long").alias("matches"),
        (F.min("played") != F.max("played")).alias("unequal_games_played"),
        (F.sum("goals_for") != F.sum("goals_against")).alias("goals_balance_mismatch"),
        any_row(F.col("wins") + F.col("draws") + F.col("losses") != F.col("played")).alias("wdl_algebra_mismatch"),
        any_row(F.col("points") != 3 * F.col("wins") + F.col("draws")).alias("points_algebra_mismatch"),
        any_row(~(finite(metrics[0]) & finite(metrics[1]) & finite(metrics[2]))).alias("nonfinite_metric"),
        any_row(~F.col(percentile).between(-1e-12, 1 + 1e-12)).alias("percentile_out_of_range"),
    )
    codes = FAILURES[4:]
    if expected is not None:
        codes = FAILURES
        declared = expected.groupBy(*keys).agg(F.max("declared_teams").alias("_teams"), F.max("expected_matches").alias("_matches"))
        agg = agg.join(declared, list(keys), "left").select(
            "*", F.isnull("_teams").alias("missing_header_teams"), F.isnull("_matches").alias("missing_expected_match_count"),
            (F.col("teams") != F.col("_teams")).alias("team_count_mismatch"), (F.col("matches") != F.col("_matches")).alias("match_count_mismatch"))
    failures = F.filter(F.array(*[F.when(F.col(c), F.lit(c)) for c in codes]), lambda x: x.isNotNull())
    return agg.select(
        *keys, "teams", "matches", F.array_join(failures, ",").alias("failures"),
        F.when(F.size(failures) == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def guarded_supplement(matches: DataFrame, extra: DataFrame, expected: DataFrame, keys: tuple[str, ...] = GROUP) -> DataFrame:
    """Status of every reviewed supplementary match: applied, already_present, group_full, evidence_missing.

    ``expected`` has the number of matches per group; ``extra`` has evidence_tokens and evidence.  Each
    supplement is judged against the ledger as it is; a small reviewed list is expected on the right.
    """
    row = [*keys, "home", "away", "home_goals", "away_goals"]
    present = extra.join(matches.select(*row).distinct().withColumn("_there", F.lit(True)), row, "left")
    counts = matches.groupBy(*keys).agg(F.count("*").alias("_n"))
    judged = present.join(expected, list(keys), "left").join(counts, list(keys), "left")
    tokens = F.forall("evidence_tokens", lambda t: F.contains(F.lower(F.regexp_replace("evidence", "<[^>]*>", " ")), F.lower(t)))
    return judged.select(
        *row, F.when(F.col("_there"), "already_present").when(F.coalesce("_n", F.lit(0)) >= F.col("expected_matches"), "group_full")
        .when(~tokens, "evidence_missing").otherwise("applied").alias("status"),
    )
