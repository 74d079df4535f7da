"""Texts with references that lack their semicolon, as the SQL of their queries has them."""

import duckdb
from pyspark.sql import functions as F

from ledgerloom.functions import dom
from ledgerloom.functions import text as T
from ledgerloom.plans import nested_plans, text_plans
from tests.oracle import same

TITLES = ["a &amp; b &amp;&amp", "x&amp", "&lt;b&gt &quot;q&quot; &#39;s&#39", "p &amp;lt; &unknown; &ampx; &", ""]


def _pages(spark, folder):
    rows = [(i, f"http://h.example/{i}", f"<html><title>{t}</title><h1 class=x>{t}</h1></html>") for i, t in enumerate(TITLES)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{folder}/pages.parquet")


def _check(spark, folder, name, plans):
    _pages(spark, folder)
    con = duckdb.connect()
    con.sql(f"create view pages as select * from read_parquet('{folder}/pages.parquet/*.parquet')")
    run, sql = plans.QUERIES[name]
    same(run(spark, str(folder)), con, sql)


def test_titles_match_sql(spark, tmp_path):
    _check(spark, tmp_path, "html_text", text_plans)


def test_both_ways_to_decode(spark):
    df = spark.createDataFrame([("<p>a&amp b &eacute;&eacute &#49;&#49 &#x31; &nosuch; &ampx;",), (None,)], "t string")
    got = df.select(T.html_text(F.col("t")).alias("all"), T.html_text(F.col("t"), ended=True).alias("ended")).collect()
    assert tuple(got[0]) == ("a& b éé 11 1 &nosuch; &x;", "a&amp b é&eacute 1&#49 1 &nosuch; &ampx;")
    assert tuple(got[1]) == (None, None)


def test_headings_match_sql(spark, tmp_path):
    _check(spark, tmp_path, "page_identity", nested_plans)


def test_pages_keep_bare_ampersands():
    page = dom.Page("<h1>a&amp &lt;b</h1><a href='/?a=1&lt=2&amp;c'>x&gt y&gt; &</a><script>a && b &amp c &lt; d</script><textarea><i t='&gt'>&gt</textarea>", ended=True)
    assert dom.clean(page.heads[0]) == "a&amp <b" and page.assets == ["/?a=1&lt=2&c"]
    assert dom.clean(page.links[0][1]) == "x&gt y> &" and "".join(page.scripts[0][2]) == "a && b &amp c &lt; d"
    assert page.fields[0].values == ["<i t='&gt'>&gt"]
