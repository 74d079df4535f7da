"""Pages with end tags left out, terms by the automaton, literals of scripts."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dom, scan


def texts(html):
    return [[c["text"] for c in r["cells"]] for r in dom.Page(html).table_rows()]


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


@pytest.mark.parametrize("html, want", [
    ("<table><tr><td>a<td>b</tr></table>", [["a", "b"]]),
    ("<tr><td>a<td>b</tr>", [["a", "b"]]),
    ("<table><tr><td>a</td><td>b<tr><td>c</table><tr><td>d", [["a", "b"], ["c"], ["d"]]),
    ("<table><thead><tr><th>A<tbody><tr><td>1<tfoot><tr><td>2</table>", [["A"], ["1"], ["2"]]),
    ("<table><tr><td>x<table><tr><td>in<td>ner</table>y<td>z</table>", [["x in ner y", "z"], ["in", "ner"]]),
    ("<table><tr><td>a</tr></tr></td></table></table><td>b", [["a"], ["b"]]),
    ("<table><td>no row<td>open<tr></tr><tr><td></table>", [["no row", "open"], [""]]),
    ("<table><tr><td>x &amp;<br>y</td><td><b>1</b></td></tr><tr></tr></table>", [["x & y", "1"]]),
    ("<table><tr><td>a<script>var t='<td>';</script><style>td{}</style>b<!-- <td> --></table>", [["ab"]]),
    ("<table><tr><td><ul><li>a<li>b</ul><td>c", [["a b", "c"]]),
    ("<p>no <table", []), ("", []), (None, []),
])
def test_cells(html, want):
    assert texts(html) == want


def test_grid_columns():
    page = dom.Page("<table><tr><td rowspan=2>a<td colspan=2>b<td>c<tr><td>d<td>e<td>f<tr><td colspan=x rowspan=0>g<td>h</table>")
    assert [[(c["text"], c["column"], c["colspan"]) for c in r["cells"]] for r in page.table_rows()] == [
        [("a", 0, 1), ("b", 1, 2), ("c", 3, 1)], [("d", 1, 1), ("e", 2, 1), ("f", 3, 1)], [("g", 0, 1), ("h", 1, 1)]]


def test_headers_are_those_of_the_first_row():
    assert dom.Page("<table><tr><td>x</table><table><tr><th>A<th>B<td>c<tr><th>row<td>1</table>").headers() == ["A", "B", "c"]
    assert dom.Page("<table><tr><td>x<tr><th>late</table>").headers() == []


def test_forms():
    page = dom.Page(
        "<form method=POST action='/s' id=f><input name=a value=1><div><form action=/inner><textarea name=t rows=2>\nline <b>one</b>\n</textarea></form>"
        "<input name=after><select name=s form=f><option value=1>one<option selected>two </select><form><select name=m multiple><option selected value=x><option value=y>"
        "<option selected>z</select><select name=none><option>o</select><button name=go>Go</button><input name=late form=f></form>")
    assert [(f["form"], f["action"], f["name"], f["type"], f["value"]) for f in page.form_fields()] == [
        (0, "/s", None, None, None), (0, "/s", "a", "input", "1"), (0, "/s", "t", "textarea", "line <b>one</b>\n"), (0, "/s", "s", "select", "two"), (0, "/s", "late", "input", None),
        (1, "", None, None, None), (1, "", "m", "select", "x"), (1, "", "m", "select", "z"), (1, "", "none", "select", None), (1, "", "go", "button", None),
        (None, None, "after", "input", None)]


def test_links_with_their_rows(spark):
    html = ("<base href='../x/'><table><tr><th>Club<td><a href=profile/7-ann>Ann <b>B</b></a><td>10 <a href='profile/8-bo'>Bo<a href=profile/7-other>again</a></table>"
            "<a HREF = \"/profile/9-cy?q#f\">Cy</a><a>none</a><a href=''>self</a>")
    pages = spark.createDataFrame([(1, "http://h/a/b/c", html), (2, "http://h/", "<a href=/profile/7-ann>A"), (3, None, None)], "k int, u string, h string")
    got = rows(dom.profile_links(pages, "k", "u", "h", r"profile/(\d+)-([^/?#]+)"), "k", "id", "slug", "label", "link", F.array_join("cells", "|"))
    assert got == [(1, "7", "ann", "Ann B", "http://h/a/x/profile/7-ann", "Ann B|10 Boagain".replace("Ann B|", "Club|Ann B|")), (1, "8", "bo", "Bo", "http://h/a/x/profile/8-bo", "Club|Ann B|10 Boagain"),
                   (1, "9", "cy", "Cy", "http://h/profile/9-cy?q#f", ""), (2, "7", "ann", "A", "http://h/profile/7-ann", "")]
    assert rows(dom.assets(pages, "k", "u", "h"), "k", "place", "asset")[:2] == [(1, 0, "http://h/a/x/profile/7-ann"), (1, 1, "http://h/a/x/profile/8-bo")]


def test_assets_keep_their_order(spark):
    html = "<script src=z.js></script><link rel=stylesheet href='../a.css'><script src=./z.js></script><img src=m.png><script>1</script><iframe src='//o/f'></iframe>"
    pages = spark.createDataFrame([(1, "http://h/p/q", html)], "k int, u string, h string")
    assert [r.asset for r in dom.assets(pages, "k", "u", "h").orderBy("place").collect()] == ["http://h/p/z.js", "http://h/a.css", "http://h/p/m.png", "http://o/f"]


def test_identity_and_scripts(spark):
    html = "<link href=/c rel='alternate canonical'><h1>A <i>b</i>\n c</h1><h1>second</h1><script id=x type=application/json>{\"a\": \"</p>\"}</script><script id='y'>no json</script><time class='bday'>1 May <b>1990</b></time>"
    df = spark.createDataFrame([(html,), (None,)], "h string").select(dom.page_parts("canonical", "h1", "scripts", "birth_days")("h").alias("p"))
    got = df.select("p.canonical", "p.h1", dom.embedded_json(F.col("p.scripts"), "x"), dom.embedded_json(F.col("p.scripts"), "y"), "p.birth_days").collect()
    assert [tuple(r) for r in got] == [("/c", "A b c", '{"a": "</p>"}', None, ["1 May 1990"]), (None, None, None, None, [])]


def test_a_page_of_many_unclosed_elements():
    page = dom.Page("<a href=x><td><b>" * 20_000)
    assert len(page.table_rows()[0]["cells"]) == 20_000 and len(page.links) == 20_000


def test_thousands_of_terms_in_one_pass(spark, monkeypatch):
    terms = [f"term{i}" for i in range(5000)] + ["term", "m1", "é"]
    body = " ".join(f"term{i}" for i in range(0, 5000, 7)) + " É é"
    docs = spark.createDataFrame([(1, body), (2, "nothing"), (3, None)], "k int, t string")
    table = spark.createDataFrame([(t,) for t in [*terms, "", None, "term1"]], "t string")
    want = {t: body.count(t) for t in terms if body.count(t)}
    for most in (scan.SLICE_TERMS, 999):
        monkeypatch.setattr(scan.term_slices, "__defaults__", (most, scan.SLICE_CHARS))
        got = {r.needle: r.hits for r in scan.keyword_hits(docs, "k", "t", table, zeros=False).collect()}
        assert got == want
    zeros = scan.keyword_hits(docs, "k", "t", ["term7", "zzz", "term"])
    assert rows(zeros) == sorted([(1, "term7", body.count("term7")), (1, "zzz", 0), (1, "term", body.count("term")), *((k, n, 0) for k in (2, 3) for n in ("term7", "zzz", "term"))], key=str)
    assert scan.keyword_hits(docs, "k", "t", table.limit(0)).count() == 0


def test_hits_and_contexts(spark):
    df = spark.createDataFrame([(1, "aXbXXc"), (2, "x"), (3, None), (4, "X"), (5, "é.X"), (6, "aaaa"), (7, "İX")], "k int, t string")
    assert rows(scan.keyword_context(df, "k", "t", ["X", "."], 1, 1)) == sorted([
        (1, "X", 1, "aXb"), (1, "X", 3, "bXX"), (1, "X", 4, "XXc"), (4, "X", 0, "X"), (5, "X", 2, ".X"), (5, ".", 1, "é.X"), (7, "X", 1, "İX")], key=str)
    assert rows(scan.term_hits(df, "k", "t", ["aa", "aaa"])) == [(6, "aa", 0), (6, "aa", 2), (6, "aaa", 0)]
    assert rows(scan.term_hits(df, "k", "t", ["aa", "aaa"], overlapping=True)) == [(6, "aa", 0), (6, "aa", 1), (6, "aa", 2), (6, "aaa", 0), (6, "aaa", 1)]
    assert rows(scan.term_hits(df, "k", "t", ["x", "X"], ignore_case=True).where("k IN (2, 7)")) == [(2, "X", 0), (2, "x", 0), (7, "X", 1), (7, "x", 1)]


def test_names_with_any_target(spark, monkeypatch):
    df = spark.createDataFrame([("Blue Wing", 1), ("red", 2), (None, 3), ("Blue Wing", 1)], "n string, k int")
    monkeypatch.setattr(scan.term_slices, "__defaults__", (1, scan.SLICE_CHARS))
    assert rows(scan.contains_any(df, "n", ["WING", "blue", "zzz"])) == [("Blue Wing", 1), ("Blue Wing", 1)]
    assert scan.contains_any(df, "n", []).count() == 0 and rows(scan.contains_any(df, "n", ["RED"], ignore_case=False)) == []


@pytest.mark.parametrize("script, want", [
    ('a="x" + b; c = d+ \'y\'; e += "z"', [(2, "joined", "x"), (18, "joined", "y"), (28, "joined", "z")]),
    ("// \"no\"\nx='y\\'z' /* \"q\" */; r = /[\"']/g; d = a / \"v\" / 2; `t`", [(10, "plain", "y'z"), (49, "plain", "v"), (58, "plain", "t")]),
    ('`a${ f({k:"in"}) + `n${1}` }b`; return /"x"/; "\\u00e9\\x41\\n\\u{1F600}"', [(10, "plain", "in"), (19, "template", "n${}"), (0, "template", "a${}b"), (46, "plain", "éA\n😀")]),
    ('"open\nx="ok"', [(8, "plain", "ok")]), ('`never ends ${ "x"', [(15, "plain", "x")]), ('x=a++ / 2 / "s"', [(12, "plain", "s")]),
    ('"a\\\nb" + /* c */ 1', [(0, "joined", "ab")]), ("", []), ("}}}`${`", []),
])
def test_literals(script, want):
    assert list(scan.literals(script)) == want


def test_routes(spark):
    html = ("<script src=x.js></script><script>let a='/season/1', b=`/season/${a}`, c=\"/season/\"+a, d='/season/{id}', e='season', f='/login/season', g='/season/1', h='/SEASON', "
            "i='/season/" + "y" * 50 + "'; // '/season/c'\n</script><p>'/season/text'</p><script>var t = \"</p>\", r='/round/2';</script>")
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<p>")], "k int, h string")
    assert rows(scan.route_candidates(pages, "h", "(?i)season|round", "login", 30)) == [(1, "/SEASON"), (1, "/round/2"), (1, "/season/1")]
    scripts = spark.createDataFrame([(1, "x='/far'; " + " " * 50 + "Season; y='/near'; z='/near'; w='/near/'+q;" + " " * 50 + "v='/far2'")], "k int, s string")
    assert rows(scan.routes_near(scripts, "k", "s", ["season", "none"], 20, 30)) == [(1, "season", "/near")]
