"""Headers of CSV files are found without sorting their lines."""

from ledgerloom.sources import rounds


def test_no_line_is_sorted_for_a_header(spark, tmp_path):
    for slot, head in (("2020-1", "\n﻿\n  \na,b"), ("2020-2", "﻿b,a"), ("2021-1", "")):
        (tmp_path / f"{slot}.csv").write_text(head + ("\n" + "0,0\n" * 5000 if head else "\n\n"), encoding="utf-8")
    found = rounds.csv_headers(spark, str(tmp_path))
    assert "Sort" not in found._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.year, r.round, rounds.column_names(r.header)) for r in found.collect())
    assert got == [(2020, 1, ["a", "b"]), (2020, 2, ["b", "a"])]
