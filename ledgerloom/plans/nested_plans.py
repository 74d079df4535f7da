"""JSON and HTML queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import dom as D
from ledgerloom.functions import nested as N
from ledgerloom.functions import scan as S
from ledgerloom.functions import text as T
from ledgerloom.operators import providers, records
from ledgerloom.sources import files
from .common import spread, table

# The same nested JSON in both engines: an object with an object, a list of mixed items and a null.
_JSON = """concat('{"id":', c_custkey, ',"team":{"teamId":', c_nationkey, ',"k-Pi":"', c_mktsegment, '"},"tags":["a",{"k":', c_custkey % 7, '}],"players":[',
  CASE WHEN c_custkey % 3 = 0 THEN '{"pid":1},{"pid":2}' ELSE '' END, '],"note":null,"ok":true', CASE WHEN c_custkey % 5 = 0 THEN ',"squad":[{"x":1}]' ELSE '' END, '}')"""


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    rows = spread(table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_mktsegment"), "c_custkey")
    return rows.selectExpr("c_custkey", f"{_JSON} AS j", "c_mktsegment")


def _nodes(spark: SparkSession, sf: str) -> DataFrame:
    return N.walk_rows(_docs(spark, sf), ["c_custkey", "c_mktsegment"], "j")


def json_key_walk(spark: SparkSession, sf: str) -> DataFrame:
    return _nodes(spark, sf).select("c_custkey", "path", "key", "kind", "value")


def json_flatten_dotted(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("c_custkey", F.explode(N.json_flatten_dotted("j")).alias("name", "value"))


def json_flatten_indexed(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("c_custkey", F.explode(N.json_flatten_indexed("j")).alias("name", "value"))


def list_locator(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("c_custkey", N.deep_list(["players", "elements"])("j").alias("path"))


def forbidden_field_guard(spark: SparkSession, sf: str) -> DataFrame:
    denied = ["KPI", "p-id"]
    return N.forbidden_fields(N.walk_rows(_docs(spark, sf), [], "j", named=denied), denied)


def labelled_id_harvest(spark: SparkSession, sf: str) -> DataFrame:
    """Loose ids of the common objects, and strict ones of objects with both kinds of keys."""
    strict = spread(table(spark, sf, "customer", "c_custkey"), "c_custkey").selectExpr("concat('{\"championship_Id\":\"', c_custkey % 50, '\",\"x\":[{\"ChampionshipID\":', c_custkey, '}],\"id\":7}') AS j")
    loose = N.labelled_ids(_nodes(spark, sf)).withColumn("form", F.lit("loose"))
    return loose.unionByName(N.labelled_ids(N.walk_rows(strict, [], "j"), strict=True).withColumn("form", F.lit("strict")))


def field_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return N.field_inventory(_docs(spark, sf), "j", ["c_mktsegment"])


def key_presence(spark: SparkSession, sf: str) -> DataFrame:
    return N.key_presence(_docs(spark, sf), "j", ["players"])


def common_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Paths that every record has a number, or a true or false, at, and whether there is but one."""
    total = _docs(spark, sf).agg(F.count("*").alias("total"))
    nodes = _nodes(spark, sf)
    found = {kind: N.common_paths(nodes.where(F.col("kind") == kind), "c_custkey", total) for kind in ("number", "boolean")}
    rows = [df.withColumns({"kind": F.lit(k), "status": F.lit("PATH")}) for k, df in found.items()]
    rows += [N.only_path(df).select("path", F.lit(k).alias("kind"), "status") for k, df in found.items()]
    return reduce(DataFrame.unionByName, rows)


def schema_profile(spark: SparkSession, sf: str) -> DataFrame:
    return N.schema_profile(_docs(spark, sf), "j", ["tags", "players", "squad", "note"])


def nested_value_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Event types whether a report is a list or one object, and the keys of a map."""
    item = F.expr("concat('{\"type\":\"', event_type, '\"}')")
    report = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("["), item, F.lit(",{\"type\":\"x\"}]"))).otherwise(item)
    return N.value_inventory(table(spark, sf, "events").select(report.alias("r"), "props"), "r", "type", "props")


def map_or_list_explode(spark: SparkSession, sf: str) -> DataFrame:
    """Players as an object map or a list; a map's key is the id where the item has none."""
    item = F.expr("concat('{\"n\":\"', c_name, '\"', if(c_custkey % 3 = 0, concat(',\"id\":', c_custkey), ''), '}')")
    body = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("["), item, F.lit("]"))).otherwise(F.concat(F.lit("{\"77\":"), item, F.lit("}")))
    rows = table(spark, sf, "customer").select("c_custkey", body.alias("body")).select("c_custkey", F.explode(N.map_or_list(F.col("body"), "n:string,id:long")).alias("e"))
    return rows.select("c_custkey", F.col("e.value.n").alias("name"), F.coalesce(F.col("e.value.id").cast("string"), F.col("e.key")).alias("id"))


def history_explode(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity")).alias("history"))
    o = table(spark, sf, "orders", "o_orderkey", "o_orderstatus").join(li, F.col("o_orderkey") == F.col("l_orderkey"))
    return N.history_rows(o, ["o_orderkey", "o_orderstatus"], "history")


def nested_results_explode(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_partkey")).alias("results"))
    o = table(spark, sf, "orders", "o_orderkey").join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return N.result_payloads(o, ["o_orderkey"], "results")


# Inline scripts with literals of all three kinds, a template with a placeholder, comments and a division.
_SCRIPT = r"""concat(html, '<script>// "/comment/season"', '\n', 'let a = "/season/', page_id % 5, '", b = \'/api/round/', page_id % 3, '?x=1\', c = `/season/$', '{a}/x`;', '\n',
  '/* \'/season/hidden\' */ var d = `/the Season\\\'s`, e = "/season/" + a, f = 4 / 2, g = "/user/login/season", h = "/season/', repeat('y', 60), '", i = "season", k = "/season/{id}";</script>')"""


def _scripted(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").selectExpr("page_id", f"{_SCRIPT} AS html")


# Pages have neither tables nor forms nor birth markup of their own, so each gets one at its end, with end tags left out.
_TABLE = "concat(html, '<table><tr><th>Page<th>N<tr><td rowspan=2><b>p', page_id, '</b><td>', length(html), '<br>x &amp; y<table><tr><td>in', page_id % 3, '</table></td><tr><td>low</table>')"
_FORM = """concat(html, '<form method="POST" action="/a', page_id, '"><input name="q" value="', length(url), '"><select name=s><option value="1">one<option selected value="2">two</select>',
  '<textarea name=t>\n x<b></textarea></form><input name=out>')"""
_BORN = "concat(html, '<p>', if(page_id % 2 = 0, concat('<span class=\"x bday\">19', 60 + page_id % 40, '-05-0', page_id % 9 + 1, '</span>'), '<time itemprop=\"birthDate\" datetime=\"1980-02-03\">3 Feb</time>'), '</p>')"
_PROFILES = """concat(html, '<table><tr><td><a href=../profile/', page_id % 7 + 1, '-name', page_id % 5, '>P <i>', page_id, '</i></a><td>team ', page_id % 3,
  '<tr><td><a href="/profile/', page_id % 7 + 1, '-again">second</a></table>')"""
_ASSETS = """concat(if(page_id % 4 = 0, '<base href="/static/v1/">', ''), html, '<script src="../d.js"></script><script src=?q=', page_id, '></script><img src=./a/../b.png><a href=#f>x</a>')"""


def _parts(spark: SparkSession, sf: str, html: str, part: str) -> DataFrame:
    return table(spark, sf, "pages").selectExpr("page_id", f"{html} AS html").select("page_id", D.page_parts(part)("html")[part].alias("p"))


def html_table_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = _parts(spark, sf, _TABLE, "rows").select("page_id", F.explode("p").alias("r"))
    return rows.select("page_id", "r.table", "r.depth", F.col("r.row").alias("row_index"), F.array_join("r.cells.text", "|").alias("cells"),
                       F.array_join(F.transform("r.cells.column", lambda c: c.cast("string")), "|").alias("columns"))


def table_headers(spark: SparkSession, sf: str) -> DataFrame:
    return _parts(spark, sf, _TABLE, "headers").select("page_id", F.array_join("p", "|").alias("headers"))


def form_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return _parts(spark, sf, _FORM, "forms").select("page_id", F.explode("p").alias("f")).select("page_id", "f.*")


def bday_markup_extract(spark: SparkSession, sf: str) -> DataFrame:
    days = _parts(spark, sf, _BORN, "birth_days").select("page_id", F.explode("p").alias("d"))
    return days.select("page_id", F.coalesce(T.iso_day(F.col("d")), T.human_date(F.col("d"))).alias("day"))


def link_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Profile links in a table with unquoted references, the first of each id, and the cells of their rows."""
    pages = table(spark, sf, "pages").selectExpr("page_id", "url", f"{_PROFILES} AS html")
    found = D.profile_links(pages, "page_id", "url", "html", r"/profile/(\d+)-([^/?#]+)")
    return found.withColumn("cells", F.array_join("cells", "|"))


def asset_links(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").selectExpr("page_id", "url", f"{_ASSETS} AS html")
    return D.assets(pages, "page_id", "url", "html")


def route_candidate_filter(spark: SparkSession, sf: str) -> DataFrame:
    return S.route_candidates(_scripted(spark, sf), "html", r"(?i)season|round", r"(?i)login|admin", 40).groupBy("route").agg(F.count("*").alias("n"))


def page_identity(spark: SparkSession, sf: str) -> DataFrame:
    html = F.concat(F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('<link rel="canonical" href="'), "url", F.lit('">'))).when(
        F.col("page_id") % 3 == 1, F.concat(F.lit("<link href='"), "url", F.lit("' rel=canonical>"))).otherwise(""), "html")
    return table(spark, sf, "pages").select("page_id", D.page_parts("canonical", "h1", ended=True)(html).alias("p")).select("page_id", "p.*")


def key_binding_check(spark: SparkSession, sf: str) -> DataFrame:
    number = F.regexp_extract("url", r"/(\d+)", 1)
    asked = F.when(F.col("page_id") % 2 == 0, number).otherwise(F.substring(number, 1, 1))
    return table(spark, sf, "pages").select("page_id", records.expected_path(F.col("url"), [asked, F.lit("en")]).alias("bound"))


def embedded_json(spark: SparkSession, sf: str) -> DataFrame:
    html = F.concat("html", F.lit("<script type='application/json' id=__NEXT_DATA__>"), F.when(F.col("page_id") % 4 == 0, "{oops").otherwise(
        F.concat(F.lit('{"props":{"id":'), "page_id", F.lit("}}"))), F.lit("</script>"))
    rows = table(spark, sf, "pages").select("page_id", D.page_parts("scripts")(html)["scripts"].alias("s"))
    rows = rows.select("page_id", D.embedded_json(F.col("s"), "__NEXT_DATA__").alias("j"))
    return rows.select("page_id", F.get_json_object("j", "$.props.id").cast("long").alias("id"))


def country_code_map(spark: SparkSession, sf: str) -> DataFrame:
    codes = {"NATION_1": "ENG", "NATION_2": "GER", "NATION_3": "NED"}
    named = providers.dim_lookup(table(spark, sf, "customer", "c_custkey", "c_nationkey"), table(spark, sf, "nation", "n_nationkey", "n_name"), "c_nationkey", "n_nationkey")
    return named.select("c_custkey", records.country_codes(F.col("n_name"), codes).alias("association"))


def src_html_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as gzip files' bytes, read as such files are."""
    stored = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("path"), files.gzipped("html").alias("content"))
    return files.pages(stored).select(F.col("path").cast("long").alias("page_id"), F.length("html").alias("chars"), "bytes", "sha256", "charset")


_D = f"d AS (SELECT c_custkey, c_mktsegment, {_JSON} AS j FROM customer)"
_TREE = f"""WITH {_D}, t AS (SELECT c_custkey, c_mktsegment, substr(x.fullkey, 3) AS path, CASE WHEN x.fullkey LIKE '%]' THEN NULL ELSE x.key END AS key,
  CASE x.type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind,
  CASE WHEN x.type NOT IN ('OBJECT', 'ARRAY') THEN x.value ->> '$' END AS value FROM d, json_tree(d.j) x WHERE x.fullkey <> '$')"""
_PATH = "replace(path, '\"', '')"

# Page urls without fragment, query or file, and the folder above.
_BASE_SQL = r"""b AS (SELECT *, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS root, regexp_replace(url, '#.*$', '') AS bare, regexp_replace(url, '[?#].*$', '') AS flat FROM pages),
      p AS (SELECT *, regexp_extract(flat, '^(https?://[^/]+/(?:.*/)?)', 1) AS folder FROM b), u AS (SELECT *, CASE WHEN folder = root || '/' THEN folder ELSE regexp_replace(folder, '[^/]*/$', '') END AS parent FROM p)"""

QUERIES = {
    "json_key_walk": (json_key_walk, _TREE + f" SELECT c_custkey, {_PATH} AS path, key, kind, value FROM t"),
    "json_flatten_dotted": (json_flatten_dotted, _TREE + f" SELECT c_custkey, {_PATH} AS name, value FROM t WHERE kind NOT IN ('object', 'array') AND path NOT LIKE '%[%' UNION ALL SELECT c_custkey, unnest(['tags', 'players']), unnest([j -> '$.tags', j -> '$.players'])::VARCHAR FROM d UNION ALL SELECT c_custkey, 'squad', (j -> '$.squad')::VARCHAR FROM d WHERE c_custkey % 5 = 0"),
    "json_flatten_indexed": (json_flatten_indexed, _TREE + f" SELECT c_custkey, {_PATH} AS name, value FROM t WHERE kind NOT IN ('object', 'array')"),
    "list_locator": (list_locator, "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'players' WHEN c_custkey % 5 = 0 THEN 'squad' END AS path FROM customer"),
    "forbidden_field_guard": (forbidden_field_guard, "SELECT 'team.k-Pi' AS path, count(*) AS violations FROM customer UNION ALL SELECT 'players[' || i || '].pid', count(*) FROM customer, range(2) r(i) WHERE c_custkey % 3 = 0 GROUP BY i"),
    "labelled_id_harvest": (labelled_id_harvest, """SELECT 'id' AS key, c_custkey AS id, 'loose' AS form FROM customer WHERE c_custkey BETWEEN 1 AND 999 UNION SELECT 'teamId', c_nationkey, 'loose' FROM customer WHERE c_nationkey > 0 UNION SELECT 'pid', unnest([1, 2]), 'loose'
      UNION SELECT 'championship_Id', c_custkey % 50, 'strict' FROM customer WHERE c_custkey % 50 > 0 UNION SELECT 'ChampionshipID', c_custkey, 'strict' FROM customer WHERE c_custkey BETWEEN 1 AND 999"""),
    "field_inventory": (field_inventory, f"WITH {_D}, k AS (SELECT DISTINCT c_mktsegment, unnest(json_keys(j)) AS k FROM d) SELECT c_mktsegment, string_agg(k, ',' ORDER BY k) AS fields FROM k GROUP BY 1"),
    "key_presence": (key_presence, f"WITH {_D}, k AS (SELECT unnest(json_keys(j)) AS key FROM d UNION ALL SELECT 'players[].pid' FROM d WHERE c_custkey % 3 = 0) SELECT key, count(*) AS n FROM k GROUP BY 1"),
    "common_paths": (common_paths, _TREE + f""", p AS (SELECT {_PATH} AS path, kind FROM t WHERE kind IN ('number', 'boolean') GROUP BY 1, 2 HAVING count(DISTINCT c_custkey) = (SELECT count(*) FROM customer))
      SELECT path, kind, 'PATH' AS status FROM p UNION ALL SELECT CASE WHEN count(p.path) = 1 THEN min(p.path) END, k.kind, CASE count(p.path) WHEN 1 THEN 'ACCEPTED' WHEN 0 THEN 'NONE' ELSE 'AMBIGUOUS' END
      FROM (SELECT unnest(['number', 'boolean']) AS kind) k LEFT JOIN p USING (kind) GROUP BY k.kind"""),
    "schema_profile": (schema_profile, """WITH s AS (SELECT '$' AS field, 'object' AS kind, CASE WHEN c_custkey % 5 = 0 THEN 7 ELSE 6 END AS length, NULL AS item_kind, CASE WHEN c_custkey % 5 = 0 THEN 'id,note,ok,players,squad,tags,team' ELSE 'id,note,ok,players,tags,team' END AS item_keys, NULL AS schema FROM customer
      UNION ALL SELECT 'tags', 'array', 2, 'string', NULL, 'ARRAY<VARIANT>' FROM customer
      UNION ALL SELECT 'players', 'array', CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 0 END, CASE WHEN c_custkey % 3 = 0 THEN 'object' END, CASE WHEN c_custkey % 3 = 0 THEN 'pid' END, CASE WHEN c_custkey % 3 = 0 THEN 'ARRAY<OBJECT<pid: BIGINT>>' ELSE 'ARRAY<VOID>' END FROM customer
      UNION ALL SELECT 'squad', 'array', 1, 'object', 'x', 'ARRAY<OBJECT<x: BIGINT>>' FROM customer WHERE c_custkey % 5 = 0 UNION ALL SELECT 'note', 'null', NULL, NULL, NULL, 'VOID' FROM customer)
      SELECT *, count(*) AS n FROM s GROUP BY ALL"""),
    "nested_value_inventory": (nested_value_inventory, """WITH a AS (SELECT 'type' AS what, event_type AS value FROM events UNION ALL SELECT 'type', 'x' FROM events WHERE event_id % 2 = 0 UNION ALL SELECT 'key', unnest(json_keys(props)) FROM events)
      SELECT what, value, count(*) AS n FROM a GROUP BY ALL"""),
    "map_or_list_explode": (map_or_list_explode, "SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN c_custkey::VARCHAR WHEN c_custkey % 2 = 1 THEN '77' END AS id FROM customer"),
    "history_explode": (history_explode, "SELECT o_orderkey, o_orderstatus, l_linenumber, l_partkey, l_quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey"),
    "nested_results_explode": (nested_results_explode, """SELECT o_orderkey, CASE WHEN l_orderkey IS NOT NULL THEN '{"l_linenumber":' || l_linenumber || ',"l_partkey":' || l_partkey || '}' END AS payload FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey"""),
    "html_table_rows": (html_table_rows, """SELECT page_id, 0 AS "table", 0 AS depth, 0 AS row_index, 'Page|N' AS cells, '0|1' AS columns FROM pages
      UNION ALL SELECT page_id, 0, 0, 1, 'p' || page_id || '|' || length(html) || ' x & y in' || page_id % 3, '0|1' FROM pages
      UNION ALL SELECT page_id, 1, 1, 0, 'in' || page_id % 3, '0' FROM pages UNION ALL SELECT page_id, 0, 0, 2, 'low', '1' FROM pages"""),
    "table_headers": (table_headers, "SELECT page_id, 'Page|N' AS headers FROM pages"),
    "form_inventory": (form_inventory, """WITH f AS (SELECT page_id, 0 AS form, 'post' AS method, '/a' || page_id AS action, unnest([NULL, 'q', 's', 't']) AS name, unnest([NULL, 'input', 'select', 'textarea']) AS type,
        unnest([NULL, length(url)::VARCHAR, '2', ' x<b>']) AS value FROM pages)
      SELECT * FROM f UNION ALL SELECT page_id, NULL, NULL, NULL, 'out', 'input', NULL FROM pages"""),
    "bday_markup_extract": (bday_markup_extract, "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN make_date(1960 + page_id % 40, 5, page_id % 9 + 1) ELSE DATE '1980-02-03' END AS day FROM pages"),
    "link_rows": (link_rows, rf"""WITH {_BASE_SQL} SELECT page_id, (page_id % 7 + 1)::VARCHAR AS id, 'name' || page_id % 5 AS slug, 'P ' || page_id AS label,
      parent || 'profile/' || (page_id % 7 + 1) || '-name' || page_id % 5 AS link, 'P ' || page_id || '|team ' || page_id % 3 AS cells FROM u"""),
    "asset_links": (asset_links, rf"""WITH {_BASE_SQL}, r AS (SELECT page_id, root || unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS asset, generate_subscripts(regexp_extract_all(html, 'href="([^"]+)"', 1), 1) AS pos FROM u
        UNION ALL SELECT page_id, unnest(CASE WHEN page_id % 4 = 0 THEN [root || '/static/d.js', root || '/static/v1/?q=' || page_id, root || '/static/v1/b.png', root || '/static/v1/#f']
          ELSE [parent || 'd.js', flat || '?q=' || page_id, folder || 'b.png', bare || '#f'] END), unnest([100001, 100002, 100003, 100004]) FROM u),
      g AS (SELECT page_id, asset, min(pos) AS pos FROM r GROUP BY ALL) SELECT page_id, asset, (row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1)::INTEGER AS place FROM g"""),
    "route_candidate_filter": (route_candidate_filter, """SELECT route, count(*) AS n FROM (SELECT page_id, unnest(list_distinct(['/season/' || page_id % 5, '/api/round/' || page_id % 3 || '?x=1', '/the Season''s'])) AS route FROM pages) GROUP BY 1"""),
    "page_identity": (page_identity, r"""SELECT page_id, CASE WHEN page_id % 3 < 2 THEN url END AS canonical, nullif(trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')), '') AS h1 FROM pages"""),
    "key_binding_check": (key_binding_check, r"""WITH p AS (SELECT page_id, string_split(regexp_replace(regexp_replace(url, '^https?://[^/]+', ''), '[?#].*$', ''), '/') AS s, regexp_extract(url, '/(\d+)', 1) AS n FROM pages)
      SELECT page_id, list_contains(s, CASE WHEN page_id % 2 = 0 THEN n ELSE substr(n, 1, 1) END) AND list_contains(s, 'en') AS bound FROM p"""),
    "embedded_json": (embedded_json, "SELECT page_id, CASE WHEN page_id % 4 <> 0 THEN page_id END AS id FROM pages"),
    "country_code_map": (country_code_map, "SELECT c_custkey, CASE n_name WHEN 'NATION_1' THEN 'ENG' WHEN 'NATION_2' THEN 'GER' WHEN 'NATION_3' THEN 'NED' ELSE upper(substr(n_name, 1, 3)) END AS association FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey"),
    "src_html_pages": (src_html_pages, "SELECT page_id, length(html)::INTEGER AS chars, strlen(html) AS bytes, sha256(html) AS sha256, 'UTF-8' AS charset FROM pages"),
}
