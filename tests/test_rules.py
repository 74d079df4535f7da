"""Rules of records, dates, reviews and tables on small cases."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import nested as N
from ledgerloom.functions import text as T
from ledgerloom.operators import audit, identity, ledger


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


@pytest.fixture(scope="module")
def nodes(spark):
    texts = ['{"Birth-Date":1,"x":{"birth_date_2":2,"list":[{"BIRTHDATE":null}]}}', '{"championship_Id":"7","id":5,"my_championship":{"ChampionshipID":1000,"champ_id":3}}',
             '{"id":"x12","pid":12.0,"team_id":" 9 ","nid":99999999999999999999,"championshipId":-1}']
    return N.walk_rows(spark.createDataFrame([(t,) for t in texts], "j string"), [], "j").cache()


def test_forbidden_fields(nodes):
    assert rows(N.forbidden_fields(nodes, ["birth_date"])) == [("Birth-Date", 1), ("x.list[0].BIRTHDATE", 1)]
    with pytest.raises(ValueError, match=r"Birth-Date \(1\), x.list"):
        N.guard_fields(nodes, ["birthDate"])
    N.guard_fields(nodes, ["birth"])


def test_labelled_ids(nodes):
    assert rows(N.labelled_ids(nodes, strict=True)) == [("championship_Id", 7)]
    assert rows(N.labelled_ids(nodes)) == [("champ_id", 3), ("championship_Id", 7), ("id", 5), ("team_id", 9)]


def test_only_path(spark):
    paths = spark.createDataFrame([("a",), ("b",)], "path string")
    assert [tuple(N.only_path(p).first()) for p in (paths, paths.limit(1), paths.limit(0))] == [("AMBIGUOUS", 2, None), ("ACCEPTED", 1, "a"), ("NONE", 0, None)]


def test_dates(spark):
    df = spark.createDataFrame([("Nàto il 3 géN 1990; nata il 31 feb 1990, NATO IL 4 dicembre 2001",), ("nato il 3 xyz 1990",), (None,)], "t string")
    assert [r[0] and [str(d) for d in r[0]] for r in df.select(T.localized_dates(F.col("t"))).collect()] == [["1990-01-03", "2001-12-04"], [], None]
    df = spark.createDataFrame([("2001-02-03", 11), ("2001-02-30", 11), ("+2001-02-03T00:00:00Z", 9), ("2001", None), (None, 11)], "v string, p int")
    assert [r[0] for r in df.select(T.day_state(F.col("v"), F.col("p"))).collect()] == ["DAY", "NO_DATE", "OTHER_PRECISION", "OTHER_PRECISION", "MISSING"]
    df = spark.createDataFrame([("a", 11), ("b", 9), ("c", None)], "s string, p int")
    assert rows(audit.other_precisions(df, "p", "s")) == [("b", 9), ("c", None)]


def test_marks_go_in_any_text(spark):
    df = spark.createDataFrame([("plain",), ("Ésprit",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(T.without_marks(F.col("t"))).collect()] == ["plain", "Esprit", None, ""]


def test_review_groups(spark):
    review = spark.createDataFrame([("ENG", "x", 2021), ("ENG", "x", 2022), ("ENG", "x", 2021), ("ITA", "y", 2021)], "a string, n string, season int")
    best = spark.createDataFrame([("ENG", "x", 2021, "second", 0.5, 2), ("ENG", "x", 2021, "first", 0.9, 1), ("ENG", "x", 2022, "only", 0.2, 1)], "a string, n string, season int, other string, score double, place int")
    got = {r.a: r for r in identity.review_groups(review, ["a", "n"], "season", best).collect()}
    assert got["ENG"].seasons == [2021, 2022] and got["ENG"].rows == 3 and [(c.season, c.names) for c in got["ENG"].candidates] == [(2021, ["first", "second"]), (2022, ["only"])]
    assert got["ITA"].candidates is None and identity.review_groups(review, ["a", "n"], "season").columns == ["a", "n", "seasons", "rows"]


def test_positions(spark):
    table = spark.createDataFrame([(1, "c", "Élan", 2.0, 0.5), (1, "c", "eagle", 2.0, 0.5), (1, "c", "Zeta", 2.0, 0.5), (1, "c", "top", 3.0, -1.0), (2, "c", "solo", 0.0, 0.0)],
                                  "season int, competition string, team string, points_per_game double, goal_difference_per_game double")
    assert rows(ledger.positions(table), "season", "position", "team") == [(1, 1, "top"), (1, 2, "eagle"), (1, 3, "Élan"), (1, 4, "Zeta"), (2, 1, "solo")]
