"""Hand-made cases: what earlier audits and failures taught."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import nested as N
from ledgerloom.functions import text as T
from ledgerloom.operators import audit, evidence, identity, ledger, master, providers, records, snapshots


BODY = "= League\r\n# Teams 4\n# Matches 12\n# Stages  Regular Season (3)  Playoffs (9)\nRegular Season (5)\n20:45  A v B  2-1 (1-0)\nC  0-0 (0-0)  D\nA v D [cancelled]\nB v C 3-0 [awarded]\nE v E 1-1\nA v C 1-1\n"


@pytest.fixture(scope="module")
def parsed(spark):
    f = spark.createDataFrame([("f", BODY)], "file string, body string")
    return ledger.parse_match_lines(ledger.explode_lines(f)), ledger.header_numbers(f)


def test_line_formats(parsed):
    rows = [(r.home, r.away, r.home_goals, r.away_goals, r.annotation) for r in parsed[0].orderBy("line_no").collect()]
    assert rows == [("A", "B", 2, 1, None), ("C", "D", 0, 0, None), ("B", "C", 3, 0, "awarded"), ("A", "C", 1, 1, None)]


def test_header_and_cutoff(parsed):
    h = parsed[1].first()
    assert (h.declared_teams, h.declared_matches, h.regular_matches) == (4, 12, 3)
    cut = ledger.regular_season(parsed[0].withColumn("k", F.lit(3)), ["file"], ["line_no"], "k")
    assert cut.count() == 3
    assert ledger.regular_season(parsed[0].withColumn("k", F.lit(None).cast("int")), ["file"], ["line_no"], "k").count() == 4


@pytest.mark.parametrize("line,want", [
    ("  18:00   FC   One  v  Two  Town   2-1  (1-0)  [awarded] ", ("FC One", "Two Town", 2, 1, "awarded")),
    ("9.30 A V B 10-0 (aet)", ("A", "B", 10, 0, None)),
    ("A v B 1-1 (pen. 4-3) [replay]", ("A", "B", 1, 1, None)),
    ("A  1-0 (aet)  B   C", ("A", "B C", 1, 0, None)),
    ("1. FC 04 3-2 SV 98", ("1. FC 04", "SV 98", 3, 2, None)),
    ("A v B", None), ("A v B [cancelled]", None), ("A v B 2-1 later", None), ("v B 1-0", None), ("A 2-1", None), ("2-1 B", None),
    ("A 3-0 B [awarded]", None), ("A v A 1-0", None), ("A 1-0 A", None), ("", None), ("# Teams 4", None),
])
def test_match_lines(spark, line, want):
    got = ledger.parse_match_lines(spark.createDataFrame([(line,)], "line string")).collect()
    assert [tuple(r)[1:] for r in got] == ([want] if want else [])


@pytest.mark.parametrize("body,want", [
    ("# Team 18\n#Match 306\n# Stage  Regular Season (306)", (18, 306, 306, 306)),
    ("# TEAMS  18 \r\n# Matches 200\r\n", (18, 200, None, 200)),
    ("Regular Season (10)\nTeams 18\n# Teams about 18\n# Teamsters 4", (None, None, None, None)),
    ("# Stages Playoffs (4)\n# Matches 20\n# Stages Cup (2), Regular Season(16)", (None, 20, 16, 16)),
    (None, (None, None, None, None)),
])
def test_headers(spark, body, want):
    r = ledger.header_numbers(spark.createDataFrame([(body,)], "body string")).first()
    assert tuple(r)[1:] == want


def test_missing_header_is_null(spark):
    r = ledger.header_numbers(spark.createDataFrame([("x",)], "body string")).first()
    assert r.declared_teams is None and r.regular_matches is None


def _table(spark, rows):
    m = spark.createDataFrame(rows, "season int, competition string, home string, away string, home_goals long, away_goals long")
    return ledger.tie_averaged_percentile(ledger.standings(m), ledger.GROUP, "points_per_game", "ppg_percentile")


def test_three_way_tie_and_audit(spark):
    t = _table(spark, [(1, "x", "A", "B", 1, 1), (1, "x", "B", "C", 0, 0), (1, "x", "C", "A", 2, 2)])
    assert {r.ppg_percentile for r in t.collect()} == {0.5}
    assert ledger.audit_groups(t).first().status == "PASS"
    bad = _table(spark, [(1, "x", "A", "B", 1, 0), (1, "x", "A", "C", 1, 0)]).withColumn("points", F.lit(9))
    r = ledger.audit_groups(bad).first()
    assert r.status == "FAIL" and r.failures == "unequal_games_played,points_algebra_mismatch"


def test_audit_of_declared_sizes(spark):
    t = _table(spark, [(y, "x", "A", "B", 1, 1) for y in (1, 2, 3)] + [(4, "x", "A", "B", 1, 0)]).where("season <> 4 OR team = 'A'")
    t = ledger.tie_averaged_percentile(t.drop("ppg_percentile"), ledger.GROUP, "points_per_game", "ppg_percentile")
    sizes = spark.createDataFrame([(1, "x", 2, 1), (2, "x", 3, 2), (4, "x", None, 1), (4, "x", None, None)], "season int, competition string, declared_teams long, expected_matches long")
    got = {r.season: (r.failures, r.status) for r in ledger.audit_groups(t, expected=sizes).collect()}
    assert got[1] == ("", "PASS") and got[2] == ("team_count_mismatch,match_count_mismatch", "FAIL")
    assert got[3] == ("missing_header_teams,missing_expected_match_count", "FAIL")
    assert got[4] == ("missing_header_teams,match_count_mismatch,goals_balance_mismatch,nonfinite_metric", "FAIL")


def test_single_team_group_has_no_percentile(spark):
    one = spark.createDataFrame([(1, "x", "A", 1.0)], "season int, competition string, team string, points_per_game double")
    assert ledger.tie_averaged_percentile(one, ledger.GROUP, "points_per_game", "p").first().p is None


def test_rank_chain_and_floor(spark):
    df = spark.createDataFrame([(1, "a", 10.0), (1, "b", 10.0 - 5e-10), (1, "c", 9.0)], "y int, n string, v double")
    assert [r.rank for r in snapshots.rank_by_gap(df, ["y"], "v", ["n"]).orderBy("n").collect()] == [1, 1, 3]
    f = snapshots.with_floor(spark.createDataFrame([(5.0, 5.0), (4.0, 5.0)], "p double, f double"), "p", "f").orderBy("p").collect()
    assert [(r.coefficient, r.uses_floor) for r in f] == [(5.0, True), (5.0, False)]


def test_component_tolerance_shrinks_with_missing_parts(spark):
    df = spark.createDataFrame([(1.0, None, 1.005), (1.0, None, 1.006), (1.0, 0.0, 1.006)], "a double, b double, t double")
    assert [r.within for r in snapshots.component_sum(df, ["a", "b"], "t", 0.0051).collect()] == [True, False, True]


def test_strict_number(spark):
    df = spark.createDataFrame([("1,234.5",), ("-3",), ("4.",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(snapshots.strict_number(F.col("t"))).collect()] == [1234.5, -3.0, None, None, None]


def test_normalisers_differ_on_undecomposable_letters(spark):
    df = spark.createDataFrame([("Łódź Straße & Søn",)], "t string")
    r = df.select(T.norm_surface(F.col("t")).alias("a"), T.norm_casefold(F.col("t")).alias("b"), T.slugify(F.col("t")).alias("c")).first()
    assert (r.a, r.b, r.c) == ("odz stra e and s n", "odz strasse s n", "odz-strae-sn")


def test_calendar_is_checked(spark):
    df = spark.createDataFrame([("Nato il 31 feb 1990 e nato il 1 mar 1991",)], "t string")
    assert [str(d) for d in df.select(T.localized_dates(F.col("t")).alias("d")).first().d] == ["1991-03-01"]


def test_precision_nine_is_no_day(spark):
    df = spark.createDataFrame([("+1990-00-00T00:00:00Z", 9), ("+1990-05-06T00:00:00Z", 11), ("{}", 11)], "t string, p int")
    assert [str(r[0]) for r in df.select(T.iso_day(F.col("t"), F.col("p"))).collect()] == ["None", "1990-05-06", "None"]


def test_truthiness_skips_zero_and_blank(spark):
    df = spark.createDataFrame([(0, " ", "x"), (None, "", None), (5, "b", "c")], "a int, b string, c string")
    assert [r[0] for r in df.select(providers.truthy(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["x", None, "5"]


def test_payload_versions(spark):
    df = spark.createDataFrame([(1, 10, "s"), (1, 11, "s"), (2, 10, "s"), (2, 11, "t"), (3, 7, "u")], "e int, p int, h string")
    got = {(r.e, r.h): r.version for r in providers.payload_versions(df, "e", "p", "h").collect()}
    assert got == {(1, "s"): "UNVERSIONED_CURRENT", (2, "s"): "PARAM_10", (2, "t"): "PARAM_11", (3, "u"): "PARAM_7"}


def test_null_safe_difference(spark):
    a = spark.createDataFrame([(None, 1), ("x", 1)], "s string, n int")
    assert [tuple(r) for r in providers.null_safe_difference(a, a.where("s IS NULL"), ["s", "n"]).collect()] == [("x", 1)]


def test_reach_ends_on_cycles(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c")], "parent string, child string")
    got = providers.reach(spark.createDataFrame([("a", "p")], "node string, page string"), e).collect()
    assert {(r.node, r.depth) for r in got} == {("a", 0), ("b", 1), ("c", 2)}


def test_cascade_prefers_best_rank_and_does_not_fan_out(spark):
    facts = spark.createDataFrame([(1, "X", "inter"), (1, "X", "milan"), (1, "X", "roma"), (1, "X", "zzz"), (1, "X", "none"), (1, "X", "gone")], "snapshot_year int, association string, norm string")
    clubs = spark.createDataFrame([(1, "X", "inter", "Inter A", 5.0, 2), (1, "X", "inter", "Inter B", 9.0, 1), (2, "X", "roma", "Roma", 1.0, 1), (1, "X", "ac milan", "Milan", 7.0, 3)],
                                  "snapshot_year int, association string, norm string, club string, coefficient double, rank int")
    alias = spark.createDataFrame([("X", "milan", "ac milan"), ("X", "gone", "nowhere")], "association string, norm string, target string")
    none = spark.createDataFrame([("X", "none")], "association string, norm string")
    got = {r.norm: (r.method, r.club) for r in identity.cascade(facts, clubs, alias, none).collect()}
    assert got == {"inter": ("EXACT", "Inter B"), "milan": ("ALIAS", "Milan"), "roma": ("GLOBAL_EXACT_ABSENT", "Roma"), "zzz": ("REVIEW_REQUIRED", None),
                   "none": ("NO_HISTORY", None), "gone": ("ALIAS_ABSENT", None)}


def test_bad_season_label_is_an_error(spark):
    with pytest.raises(Exception, match="bad season label"):
        spark.createDataFrame([("2021",)], "l string").select(identity.snapshot_year(F.col("l"))).collect()


def test_conflict_rules(spark):
    df = spark.createDataFrame([([], ["a"]), (["a"], ["a", "b"]), (["c"], ["a"]), (["a", "b"], ["a"])], "o array<string>, e array<string>")
    assert [r[0] for r in df.select(evidence.resolve_conflict(F.col("o"), F.col("e"))).collect()] == ["UNRESOLVED", "RESOLVED", "NEW_CONFLICT", "CONFLICT_REMAINS"]


def test_reused_id_stays_two_persons(spark):
    cur = spark.createDataFrame([("s1", None, "Q1"), ("s2", "p9", "Q1")], "subject string, bridge string, entity string")
    his = spark.createDataFrame([("p1", "Q1"), ("p2", "Q1")], "person string, entity string")
    assert {r.subject: r.person for r in master.person_keys(cur, his).collect()} == {"s1": "entity:Q1", "s2": "p9"}


def test_last_override_wins_without_a_day(spark):
    s = "subject string, status string, day string"
    base = spark.createDataFrame([("a", "V", "d"), ("b", None, None)], s)
    over = [spark.createDataFrame([("a", "OPEN", "x")], s), spark.createDataFrame([("a", "DOB_CONFLICT", None)], s)]
    got = {r.subject: (r.status, r.day, r.origin) for r in master.apply_overrides(base, over).collect()}
    assert got == {"a": ("DOB_CONFLICT", None, 2), "b": ("UNACCOUNTED", None, 0)}


def test_page_crawl_ends_at_first_page_without_new_items(spark):
    df = spark.createDataFrame([("s", 1, 1), ("s", 1, 2), ("s", 2, 1), ("s", 3, 9)], "scope string, page int, id int")
    got = {r.page: (r.new_items, r.used) for r in audit.page_manifest(df, ["scope"], "id", "page", ["id"]).collect()}
    assert got == {1: (2, True), 2: (0, False), 3: (1, False)}


def test_walk_and_lists(spark):
    df = spark.createDataFrame([('{"a":[{"b":1}],"c":null}',), ("oops",), (None,)], "j string")
    assert [r.path for r in N.walk_rows(df, [], "j").collect()] == ["a", "a[0]", "a[0].b", "c"]
    assert [r[0] for r in df.select(N.deep_list(["x"])("j")).collect()] == ["a", None, None]


def test_twenty_digits_end_no_job(spark):
    long = "9" * 20
    df = spark.createDataFrame([(f'{{"id":"{long}","pid":"7"}}',), (f'{{"id":"{long}"}} user/{long}',), ("user/12",)], "t string")
    assert [r[0] for r in df.select(records.extract_id(F.col("t"), ["id", "pid"], [r"user/(\d+)"])).collect()] == [7, None, 12]
    body = f"# Teams {long}\n# Teams 4\n# Matches {long}\n# Stages Regular Season ({long})\nA v B {long}-1\nC 1-{long} D\nA v C 2-1\n"
    f = spark.createDataFrame([("f", body)], "file string, body string")
    assert [(r.home, r.away) for r in ledger.parse_match_lines(ledger.explode_lines(f)).collect()] == [("A", "C")]
    assert tuple(ledger.header_numbers(f).first()[2:]) == (4, None, None, None)
