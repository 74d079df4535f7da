"""Deep JSON helpers: small Arrow-batched walkers whose long output Spark filters and groups.

Depth and keys are unknown, so a walk gives long rows (path, key, kind, value), never wide columns.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from json.decoder import scanstring

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import MapType, StringType

_TEXT = StringType()


def _kind(x) -> str:
    return {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}.get(type(x), "number")


def _scalar(x) -> str | None:
    return x if isinstance(x, str) else None if x is None else json.dumps(x)


def _nodes(root):
    """(path, key, node, inside a list) of the root and every node below it in document order; ``a[0].b`` paths."""
    todo = [("", None, root, False)]
    while todo:
        at, key, x, listed = todo.pop()
        yield at, key, x, listed
        if isinstance(x, dict):
            todo += [(f"{at}.{k}" if at else k, k, v, listed) for k, v in reversed(x.items())]
        elif isinstance(x, list):
            todo += [(f"{at}[{i}]", None, v, True) for i, v in reversed(list(enumerate(x)))]


def walk(root):
    """(path, key, kind, value) of every node below the root; objects and lists have no value."""
    for at, key, x, _ in _nodes(root):
        if at:
            yield at, key, _kind(x), None if isinstance(x, (dict, list)) else _scalar(x)


def _parsed(text):
    try:
        return json.loads(text)
    except (TypeError, ValueError):
        return None


def _compact(x) -> str:
    return json.dumps(x, separators=(",", ":"), ensure_ascii=False)


_BLANK = re.compile(r"[ \t\n\r]*")
_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(\.[0-9]+)?([eE][-+]?[0-9]+)?")
_NAMES = {"true": ("boolean", "true"), "false": ("boolean", "false"), "null": ("null", None), "NaN": ("number", "NaN"), "Infinity": ("number", "Infinity"), "-Infinity": ("number", "-Infinity")}
_NAME = re.compile("|".join(_NAMES))


def stream(text: str):
    """(path, key, kind, value) of every node below the root, while the text is read; no tree is built.

    A key that an object holds twice gives two nodes.  What is no JSON raises ``ValueError`` where it ends to be.
    """
    open_: list[list] = []  # [path, next place in a list, or None in an object]
    at, path, key = _BLANK.match(text).end(), "", None
    while True:
        c = text[at : at + 1]
        if c in ("{", "["):
            if path:
                yield path, key, "object" if c == "{" else "array", None
            open_.append([path, 0 if c == "[" else None])
            at = _BLANK.match(text, at + 1).end()
            if text[at : at + 1] == ("}" if c == "{" else "]"):
                open_.pop()
                at += 1
            elif c == "[":
                path, key, open_[-1][1] = f"{path}[0]", None, 1
                continue
            else:
                path, key, at = _member(text, at, open_[-1][0])
                continue
        else:
            if c == '"':
                value, at = scanstring(text, at + 1, True)
                kind = "string"
            elif name := _NAME.match(text, at):
                (kind, value), at = _NAMES[name[0]], name.end()
            elif number := _NUMBER.match(text, at):
                kind, at = "number", number.end()
                value = json.dumps(float(number[0]) if number[1] or number[2] else int(number[0]))
            else:
                raise ValueError(f"no JSON value at {at}")
            if path:
                yield path, key, kind, value
        while True:  # what follows a value
            at = _BLANK.match(text, at).end()
            if not open_:
                if at < len(text):
                    raise ValueError(f"more text at {at}")
                return
            above, place = open_[-1]
            c = text[at : at + 1]
            if c == ",":
                at = _BLANK.match(text, at + 1).end()
                if place is None:
                    path, key, at = _member(text, at, above)
                else:
                    path, key, open_[-1][1] = f"{above}[{place}]", None, place + 1
                break
            if c != ("}" if place is None else "]"):
                raise ValueError(f"no end of a value at {at}")
            open_.pop()
            at += 1


def _member(text: str, at: int, above: str) -> tuple[str, str, int]:
    """(path, key, start of the value) of an object's member."""
    if text[at : at + 1] != '"':
        raise ValueError(f"no key at {at}")
    key, at = scanstring(text, at + 1, True)
    at = _BLANK.match(text, at).end()
    if text[at : at + 1] != ":":
        raise ValueError(f"no colon at {at}")
    return f"{above}.{key}" if above else key, key, _BLANK.match(text, at + 1).end()


def _is_json(text: str | None) -> bool:
    if text is None:
        return False
    try:
        if len(text) < 1 << 20:
            try:
                json.loads(text)
                return True
            except RecursionError:
                pass  # deeper than that parser goes
        for _ in stream(text):
            pass
        return True
    except ValueError:
        return False


def _letters(name: str) -> str:
    return re.sub("[^a-z0-9]", "", name.lower())


def walk_rows(df: DataFrame, keep: list[str], text: str, rows: int = 20_000, named: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of every row beside (path, key, kind, value) of each node of its JSON text, in document order.

    Nodes leave a task in batches of ``rows``, so memory follows the longest text, not the number of its
    nodes.  A text that is no JSON has none.  With ``named`` only nodes leave whose key is one of these names,
    lower-cased and without anything but a-z and 0-9.
    """
    wanted = None if named is None else {_letters(name) for name in named}
    kept = df.select(*keep)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "path string", "key string", "kind string", "value string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, bool] = {None: False}  # keys, whether they are wanted

        def want(key: str | None) -> bool:
            if key not in known:
                if len(known) > 10_000:
                    known.clear()
                known[key] = key is not None and _letters(key) in wanted
            return known[key]

        for batch in batches:
            at, nodes = [], []

            def flush() -> pa.RecordBatch:
                own = pa.array(at, pa.int64())
                out = pa.RecordBatch.from_arrays([*(batch.column(j).take(own) for j in range(len(keep))), *(pa.array(c, pa.string()) for c in zip(*nodes))], [*keep, "path", "key", "kind", "value"])
                at.clear()
                nodes.clear()
                return out

            for i in range(batch.num_rows):
                body = batch.column(len(keep))[i].as_py()
                for node in stream(body) if _is_json(body) else ():
                    if wanted is not None and not want(node[1]):
                        continue
                    at.append(i)
                    nodes.append(node)
                    if len(nodes) == rows:
                        yield flush()
            if nodes:
                yield flush()

    return df.select(*keep, F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


@pandas_udf(MapType(_TEXT, _TEXT))
def json_flatten_dotted(x: pd.Series) -> pd.Series:
    """Objects as dotted names; lists stay compact JSON text."""
    def one(t):
        leaves = ((at, v) for at, _, v, listed in _nodes(_parsed(t)) if at and not listed and not isinstance(v, dict))
        return {at: _compact(v) if isinstance(v, list) else _scalar(v) for at, v in leaves}

    return x.map(one)


@pandas_udf(MapType(_TEXT, _TEXT))
def json_flatten_indexed(x: pd.Series) -> pd.Series:
    """Every scalar under its ``a[0].b`` path."""
    return x.map(lambda t: {p: v for p, _, kind, v in walk(_parsed(t)) if kind not in ("object", "array")})


@pandas_udf(_TEXT)
def canonical_json(x: pd.Series) -> pd.Series:
    """The JSON text with sorted keys at every depth and no spaces; a text that is no JSON gives null."""
    def one(t):
        node = _parsed(t)
        return None if node is None and t != "null" else json.dumps(node, sort_keys=True, separators=(",", ":"), ensure_ascii=False)

    return x.map(one)


def deep_list(preferred: list[str]):
    """UDF: path of the first non-empty list of objects under a preferred key, else the first in the tree."""

    @pandas_udf(_TEXT)
    def locate(x: pd.Series) -> pd.Series:
        def one(t):
            found: dict = {}
            for at, key, v, _ in _nodes(_parsed(t)):
                if isinstance(v, list) and v and all(isinstance(e, dict) for e in v):
                    found.setdefault(key, at)
                    found.setdefault(..., at)
            return next((found[k] for k in preferred if k in found), found.get(...))

        return x.map(one)

    return locate


def field_inventory(df: DataFrame, text: str, group: list[str]) -> DataFrame:
    """(group, fields): the sorted union of top-level keys."""
    keys = df.select(*group, F.explode(F.json_object_keys(text)).alias("_k")).distinct()
    return keys.groupBy(*group).agg(F.array_join(F.array_sort(F.collect_list("_k")), ",").alias("fields"))


def key_presence(df: DataFrame, text: str, lists: list[str]) -> DataFrame:
    """(key, n): texts that have each top-level key, and ``list[].key`` for the first items of the named lists."""
    def named(prefix: str, column) -> Column:
        return F.transform(F.array_distinct(F.coalesce(F.json_object_keys(column), F.array().cast("array<string>"))), lambda k: F.concat(F.lit(prefix), k))

    keys = F.concat(named("", F.col(text)), *[named(f"{name}[].", F.get_json_object(text, f"$.{name}[0]")) for name in lists])
    return df.select(F.explode(keys).alias("key")).groupBy("key").agg(F.count("*").alias("n"))


def value_inventory(df: DataFrame, report: str, field: str, maps: str) -> DataFrame:
    """(what, value, n): values of ``field`` in a list of objects or one object, and the keys of a map."""
    listed = F.startswith(F.ltrim(report), F.lit("["))
    items = F.when(listed, F.from_json(report, f"array<struct<`{field}`:string>>")).otherwise(F.array(F.from_json(report, f"struct<`{field}`:string>")))
    values = df.select(F.explode(items).alias("e")).select(F.lit(field).alias("what"), F.col(f"e.`{field}`").alias("value"))
    keys = df.select(F.lit("key").alias("what"), F.explode(F.json_object_keys(maps)).alias("value"))
    return values.unionByName(keys).groupBy("what", "value").agg(F.count("*").alias("n"))


def schema_profile(df: DataFrame, text: str, lists: list[str], group: list[str] = []) -> DataFrame:
    """(group, field, kind, length, item_kind, item_keys, schema, n): shapes of payloads and of their named list fields.

    The payload itself is field ``$``: its JSON kind, its number of keys or items, and its keys.  A list field
    gives its length and the kind and sorted keys of its first item; a field of another kind has its kind
    alone, a field that is not there no row.  ``schema`` is the type of a payload's or list's items as a
    variant has it.  A text that is no JSON has kind ``invalid``, a null text ``missing``.
    """
    payload = F.try_parse_json(text)
    paths = [("$", "$"), *((f, f"$.{f}") for f in lists)]
    each = F.array(*[F.struct(F.lit(name).alias("field"), F.try_variant_get(payload, path, "variant").alias("v")) for name, path in paths])
    rows = df.select(*group, F.col(text).alias("_t"), F.explode(each).alias("x")).where("x.v IS NOT NULL OR x.field = '$'")
    value = F.col("x.v")
    kind = F.when(F.col("_t").isNull(), "missing").when(value.isNull(), "invalid").otherwise(variant_kind(value))
    body = F.to_json(value)
    first = F.try_variant_get(value, "$[0]", "variant")
    listed, keyed = kind == "array", kind == "object"
    length = F.when(listed, F.json_array_length(body)).when(keyed, F.size(F.json_object_keys(body)))
    item = F.when(listed, F.when(first.isNotNull(), variant_kind(first)))
    keys = F.when(keyed, F.json_object_keys(body)).when(item == "object", F.json_object_keys(F.to_json(first)))
    shape = F.when(value.isNotNull() & (F.col("x.field") != "$"), F.schema_of_variant(value))
    made = rows.select(*group, F.col("x.field").alias("field"), kind.alias("kind"), length.alias("length"), item.alias("item_kind"),
                       F.array_join(F.array_sort(keys), ",").alias("item_keys"), shape.alias("schema"))
    return made.groupBy(*made.columns).agg(F.count("*").alias("n"))


def variant_kind(value: Column) -> Column:
    """JSON kind of a variant: object, array, string, number, boolean or null."""
    shape = F.schema_of_variant(value)
    return F.when(shape == "VOID", "null").when(F.startswith(shape, F.lit("OBJECT")), "object").when(F.startswith(shape, F.lit("ARRAY")), "array").when(
        shape == "STRING", "string").when(shape == "BOOLEAN", "boolean").otherwise("number")


def merged_schema(df: DataFrame, text: str, group: list[str]) -> DataFrame:
    """(group, schema, payloads, conflicts): one variant schema for all JSON texts of a group; parts in which they disagree are VARIANT there."""
    made = df.select(*group, F.try_parse_json(text).alias("_v")).where("_v IS NOT NULL")
    found = made.groupBy(*group).agg(F.schema_of_variant_agg("_v").alias("schema"), F.count("*").alias("payloads"))
    return found.withColumn("conflicts", F.regexp_count("schema", F.lit(r"\bVARIANT\b")))


def map_or_list(text: Column, item: str) -> Column:
    """Array of (key, value): items of a JSON list (key null), or of an object with its keys; null for other texts."""
    listed = F.transform(F.from_json(text, f"array<struct<{item}>>"), lambda x: F.struct(F.lit(None).cast("string").alias("key"), x.alias("value")))
    return F.when(F.startswith(F.ltrim(text), F.lit("[")), listed).otherwise(F.map_entries(F.from_json(text, f"map<string,struct<{item}>>")))


def history_rows(df: DataFrame, parents: list[str], history: str) -> DataFrame:
    """One row per element of a list of structs, the parent columns repeated."""
    return df.select(*parents, F.explode(history).alias("_h")).select(*parents, "_h.*")


def result_payloads(df: DataFrame, parents: list[str], results: str) -> DataFrame:
    """One row per element as JSON; a parent without elements keeps one row with a null payload."""
    return df.select(*parents, F.explode_outer(results).alias("_r")).select(*parents, F.to_json("_r").alias("payload"))


def forbidden_fields(nodes: DataFrame, denied: list[str]) -> DataFrame:
    """(path, violations): nodes whose key, lower-cased and without anything but a-z and 0-9, is a denied name; whole names only."""
    names = [_letters(d) for d in denied]
    return nodes.where(F.regexp_replace(F.lower("key"), "[^a-z0-9]", "").isin(names)).groupBy("path").agg(F.count("*").alias("violations"))


def guard_fields(nodes: DataFrame, denied: list[str], told: int = 20) -> None:
    """Raise ``ValueError`` if a denied field occurs; the message names the first ``told`` paths."""
    found = forbidden_fields(nodes, denied).orderBy("path").limit(told).collect()
    if found:
        raise ValueError("forbidden fields: " + ", ".join(f"{r.path} ({r.violations})" for r in found))


def labelled_ids(nodes: DataFrame, strict: bool = False, most: int = 999) -> DataFrame:
    """(key, id): the distinct whole numbers from 1 to ``most`` under keys that name an id, numbers or digits in a text.

    Any key with ``id`` counts; with ``strict`` only one that, without case and underscores, has
    ``championship`` and ends in ``id``.
    """
    key = F.replace(F.lower("key"), F.lit("_"), F.lit(""))
    named = F.contains(key, F.lit("championship")) & F.endswith(key, F.lit("id")) if strict else F.contains(F.lower("key"), F.lit("id"))
    ids = F.when(F.col("value").rlike("^ *[-+]?[0-9]+ *$"), F.trim("value")).try_cast("long")
    found = nodes.where(F.col("kind").isin("number", "string") & named).select("key", ids.alias("id"))
    return found.where(F.col("id").between(1, most)).distinct()


def only_path(paths: DataFrame) -> DataFrame:
    """(status, paths, path): ACCEPTED with the path if there is exactly one, else NONE or AMBIGUOUS without."""
    agg = paths.agg(F.count("*").alias("paths"), F.min("path").alias("_p"))
    status = F.when(F.col("paths") == 1, "ACCEPTED").when(F.col("paths") == 0, "NONE").otherwise("AMBIGUOUS")
    return agg.select(status.alias("status"), "paths", F.when(F.col("paths") == 1, F.col("_p")).alias("path"))


def common_paths(nodes: DataFrame, record: str, total: DataFrame) -> DataFrame:
    """(path): paths that every record has a node at; ``total`` is one row with the number of records."""
    return nodes.groupBy("path").agg(F.count_distinct(record).alias("n")).crossJoin(total).where("n = total").select("path")
