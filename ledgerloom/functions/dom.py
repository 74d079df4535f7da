"""Tables, links, forms and scripts of web pages, by a stack of open elements.

Pages leave out end tags, nest tables and close what is not open.  The parser keeps a stack of the open
elements that matter here; a start tag first ends what it implies to be over, but nothing beyond the
innermost table (or list or selection).  Everything is found in one pass; an Arrow-batched helper parses
page by page and gives only the parts that are asked for.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from .text import by_reference
from .urls import resolve

_CELLS, _SECTIONS = frozenset({"td", "th"}), frozenset({"thead", "tbody", "tfoot"})
#: start tag -> (open elements that it ends, elements that shelter what is outside of them)
_ENDS = {
    **dict.fromkeys(_CELLS, (_CELLS, {"table"})), "tr": (_CELLS | {"tr"}, {"table"}), **dict.fromkeys(_SECTIONS, (_CELLS | _SECTIONS | {"tr"}, {"table"})),
    "caption": (_CELLS | {"tr"}, {"table"}), "li": ({"li"}, {"ul", "ol", "table"} | _CELLS), "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "a": ({"a"}, {"table"} | _CELLS), "select": ({"option", "optgroup", "select"}, {"table"}),
}
_SHELTERS = {"td": {"table"}, "th": {"table"}, "tr": {"table"}, **dict.fromkeys(_SECTIONS, {"table"}), "li": {"ul", "ol", "table"}, "option": {"select"}, "optgroup": {"select"}}
_KEPT = set(_ENDS) | {"table", "ul", "ol", "textarea", "h1"}
#: Elements whose edges part words.
_BLOCKS = set("address article aside blockquote br caption dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol option p pre section table tbody td tfoot th thead tr ul".split())
_MOST_COLUMNS = 1000
#: Pages whose parts are turned into Arrow at once.
_SLICE = 64
#: Stands for an ampersand that begins no reference while a page is parsed; a lone surrogate is in no text of Spark.
_BARE = "\udc26"


def clean(parts: list[str]) -> str:
    return re.sub(r"\s+", " ", "".join(parts)).strip()


def _count(value: str | None, most: int) -> int:
    return min(max(int(value), 1), most) if value and value.strip().isdecimal() else 1


class Table:
    def __init__(self, number: int, depth: int):
        self.number, self.depth, self.rows = number, depth, 0
        self.below: dict[int, int] = {}  # column -> rows that a cell above still covers


class Row:
    def __init__(self, table: Table):
        self.table, self.number, self.cells, self.column = table, table.rows, [], 0
        table.rows += 1
        self.covered = set(table.below)
        table.below = {c: n - 1 for c, n in table.below.items() if n > 1}


class Cell:
    """A cell with its column in the grid, counted with the spans of the cells before and above it."""

    def __init__(self, row: Row, tag: str, at: dict):
        while row.column in row.covered:
            row.column += 1
        self.head, self.parts, self.column = tag == "th", [], row.column
        self.colspan, self.rowspan = _count(at.get("colspan"), _MOST_COLUMNS), _count(at.get("rowspan"), 65534)
        row.column += self.colspan
        if self.rowspan > 1:
            row.table.below.update(dict.fromkeys(range(self.column, row.column), self.rowspan - 1))
        row.cells.append(self)


class Field:
    def __init__(self, form, at: dict, tag: str):
        self.form, self.owner, self.tag, self.name = form, at.get("form"), tag, at.get("name")
        self.type, self.values, self.parts = at.get("type") or tag, [at.get("value")], []
        self.many = "multiple" in at


class Page(HTMLParser):
    def __init__(self, text: str | None, ended: bool = False):
        super().__init__(convert_charrefs=True)
        self.ended = ended
        self.stack: list[tuple[str, object]] = []
        self.listening: list[list[str]] = []  # texts that are being collected
        self.rows: list[Row] = []
        self.links: list[tuple[str, list[str], Row | None]] = []
        self.forms: list[dict] = []
        self.fields: list[Field] = []
        self.scripts: list[tuple[str | None, str | None, list[str]]] = []
        self.assets: list[str] = []
        self.days: list[str | list[str]] = []
        self.heads: list[list[str]] = []
        self.canonical = self.base = None
        self.form: dict | None = None
        self.script: list[str] | None = None
        self.tables = 0
        self.feed(by_reference(text or "", str, _BARE) if ended else text or "")
        self.close()
        self._pop(0)

    # -- the stack

    def _pop(self, to: int) -> None:
        while len(self.stack) > to:
            tag, held = self.stack.pop()
            for parts in (held if isinstance(held, list) else []):
                self.listening[:] = [p for p in self.listening if p is not parts]
            if tag == "textarea" and self.fields:
                body = "".join(self.fields[-1].parts)
                self.fields[-1].values = [body[1:] if body.startswith("\n") else body]

    def _find(self, tags: set, shelters: set) -> int | None:
        """Place of the outermost of the open ``tags`` within the shelter."""
        found = None
        for place in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[place][0]
            if tag in shelters:
                break
            if tag in tags:
                found = place
        return found

    def _inner(self, tag: str) -> object | None:
        for name, held in reversed(self.stack):
            if name == tag:
                return held
            if name == "table":
                return None
        return None

    def _push(self, tag: str, held: object = None, *parts: list[str]) -> None:
        self.listening += parts
        self.stack.append((tag, list(parts) if parts else held))

    # -- events

    def handle_starttag(self, tag, attrs):
        at = dict(reversed(attrs))  # the first of repeated attributes counts
        if self.ended:
            at = {k: v and v.replace(_BARE, "&") for k, v in at.items()}
        if self.stack and self.stack[-1][0] == "textarea":
            self._say(self.get_starttag_text().replace(_BARE, "&"))  # a text area has text alone
            return
        if tag in _BLOCKS:
            self._say(" ")
        if tag in _ENDS:
            place = self._find(*_ENDS[tag])
            if place is not None:
                self._pop(place)
        if tag == "table":
            self._push(tag, Table(self.tables, sum(t == "table" for t, _ in self.stack)))
            self.tables += 1
        elif tag == "tr" or tag in _CELLS:
            if not any(t == "table" for t, _ in self.stack):
                self._push("table", Table(self.tables, 0))
                self.tables += 1
            if tag == "tr" or self._inner("tr") is None:
                self.rows.append(Row(self._inner("table") or self._table()))
                self._push("tr", self.rows[-1])
            if tag in _CELLS:
                cell = Cell(self._inner("tr"), tag, at)
                self._push(tag, None, cell.parts)
        elif tag == "a" and at.get("href") is not None:
            parts: list[str] = []
            self.links.append((at["href"], parts, self._row()))
            self._push(tag, None, parts)
        elif tag == "form" and self.form is None:
            self.form = {"method": (at.get("method") or "get").lower(), "action": at.get("action") or "", "id": at.get("id")}
            self.forms.append(self.form)
        elif tag in ("input", "select", "textarea", "button"):
            self.fields.append(Field(self.form, at, tag))
            if tag == "select":
                self.fields[-1].values = []
                self._push(tag, self.fields[-1])
            elif tag == "textarea":
                self._push(tag, None, self.fields[-1].parts)
        elif tag == "option":
            select = next((held for t, held in reversed(self.stack) if t == "select"), None)
            parts = []
            if select is not None and "selected" in at:
                value = at["value"] if at.get("value") is not None else parts
                select.values = [*select.values, value] if select.many else [value]
            self._push(tag, None, parts)
        elif tag == "script":
            if at.get("src") is None:
                self.script = []
                self.scripts.append((at.get("id"), at.get("type"), self.script))
        elif tag == "link" and "canonical" in (at.get("rel") or "").lower().split() and self.canonical is None:
            self.canonical = at.get("href")
        elif tag == "base" and self.base is None:
            self.base = at.get("href")
        elif tag == "h1":
            self.heads.append([])
            self._push(tag, None, self.heads[-1])
        elif tag in _KEPT:
            self._push(tag)
        where = {"script": "src", "img": "src", "iframe": "src", "source": "src", "link": "href", "a": "href"}.get(tag)
        if where and at.get(where):
            self.assets.append(at[where])
        if "bday" in (at.get("class") or "").split() or (tag == "time" and "birth" in (at.get("itemprop") or "").lower()):
            if at.get("datetime"):
                self.days.append(at["datetime"])
            else:
                self.days.append([])
                self._push(f"day {tag}", None, self.days[-1])

    def handle_endtag(self, tag):
        if self.stack and self.stack[-1][0] == "textarea" and tag != "textarea":
            self._say(f"</{tag}>")
            return
        if tag in _BLOCKS:
            self._say(" ")
        if tag == "form":
            self.form = None
        elif tag == "script":
            self.script = None
        for name in (f"day {tag}", tag):
            shelters = _SHELTERS.get(tag, {"table"} if tag != "table" else set())
            for place in range(len(self.stack) - 1, -1, -1):
                if self.stack[place][0] == name:
                    self._pop(place)
                    break
                if self.stack[place][0] in shelters:
                    break

    def handle_data(self, data):
        if self.ended:
            data = data.replace(_BARE, "&")
        if self.script is not None:
            self.script.append(data)
        elif self.cdata_elem is None or self.cdata_elem in ("textarea", "title"):
            self._say(data)

    def _say(self, data: str) -> None:
        for parts in self.listening:
            parts.append(data)

    def _table(self) -> Table:
        return next(held for t, held in reversed(self.stack) if t == "table")

    def _row(self) -> Row | None:
        """The row of the innermost table."""
        return self._inner("tr")

    # -- results

    def table_rows(self) -> list[dict]:
        return [{
            "table": r.table.number, "depth": r.table.depth, "row": r.number,
            "cells": [{"text": clean(c.parts), "head": c.head, "column": c.column, "colspan": c.colspan, "rowspan": c.rowspan} for c in r.cells],
        } for r in self.rows if r.cells]

    def headers(self) -> list[str]:
        """The cells of the first row of the first table with a header cell there; else none."""
        first = [r["cells"] for r in self.table_rows() if r["row"] == 0 and any(c["head"] for c in r["cells"])]
        return [c["text"] for c in first[0]] if first else []

    def link_rows(self) -> list[dict]:
        return [{
            "href": href, "label": clean(parts), "table": row and row.table.number, "row": row and row.number,
            "cells": [clean(c.parts) for c in row.cells] if row else [],
        } for href, parts, row in self.links]

    def form_fields(self) -> list[dict]:
        """Every form once, without a field, then its fields; fields outside of all forms have no form number."""
        ids = {f["id"]: f for f in reversed(self.forms) if f["id"]}
        out = [{"form": i, "method": f["method"], "action": f["action"], "name": None, "type": None, "value": None} for i, f in enumerate(self.forms)]
        for field in self.fields:
            form = ids.get(field.owner) if field.owner else field.form
            number = next((i for i, f in enumerate(self.forms) if f is form), None) if form else None
            for value in field.values or [None]:
                out.append({"form": number, "method": form and form["method"], "action": form and form["action"], "name": field.name, "type": field.type,
                            "value": clean(value) if isinstance(value, list) else value})
        return sorted(out, key=lambda f: (f["form"] is None, f["form"] or 0))

    def birth_days(self) -> list[str]:
        return [d if isinstance(d, str) else clean(d) for d in self.days]


_ROWS = "array<struct<table:int,depth:int,row:int,cells:array<struct<text:string,head:boolean,column:int,colspan:int,rowspan:int>>>>"
#: part -> (its type, how it is got)
PARTS = {
    "rows": (_ROWS, Page.table_rows),
    "headers": ("array<string>", Page.headers),
    "links": ("array<struct<href:string,label:string,table:int,row:int,cells:array<string>>>", Page.link_rows),
    "forms": ("array<struct<form:int,method:string,action:string,name:string,type:string,value:string>>", Page.form_fields),
    "birth_days": ("array<string>", Page.birth_days),
    "assets": ("array<string>", lambda p: p.assets),
    "scripts": ("array<struct<id:string,type:string,body:string>>", lambda p: [{"id": i, "type": t, "body": "".join(b)} for i, t, b in p.scripts]),
    "canonical": ("string", lambda p: p.canonical),
    "base": ("string", lambda p: p.base),
    "h1": ("string", lambda p: clean(p.heads[0]) or None if p.heads else None),
}


def page_parts(*names: str, ended: bool = False):
    """UDF: a struct of the named ``PARTS`` of a page, from one parse.  A null page has no rows, links or text.

    Old entities without a semicolon (``&amp``) are decoded too, as browsers do; with ``ended`` they stay as they are.
    """
    kind = StructType.fromDDL(",".join(f"{name} {PARTS[name][0]}" for name in names))

    def found(text: str | None) -> dict:
        page = Page(text, ended)
        return {name: PARTS[name][1](page) for name in names}

    @arrow_udf(kind)
    def parts(x: pa.Array) -> pa.Array:
        # one page is held at a time, and the parts of a few as objects; the rest of a batch is Arrow
        made = to_arrow_type(kind)
        done = [pa.array([found(t.as_py()) for t in x[at : at + _SLICE]], made) for at in range(0, len(x), _SLICE)]
        return pa.concat_arrays(done) if done else pa.array([], made)

    # Spark runs such a function once a page; of others it makes a second copy for the filter that explode implies
    return parts.asNondeterministic()


def base_url(url: Column, base: Column) -> Column:
    """The url against which a page's references resolve: its ``base`` element's, itself resolved, else its own."""
    return F.when(F.coalesce(base, F.lit("")) == "", url).otherwise(resolve(url, base))


def assets(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(key, place, asset): the distinct absolute urls of scripts, images, frames and links, in the order of their first mention."""
    rows = pages.select(key, url, page_parts("assets", "base")(html).alias("p"))
    each = rows.select(key, base_url(F.col(url), F.col("p.base")).alias("_b"), F.posexplode("p.assets").alias("_at", "_ref"))
    named = each.select(key, "_at", resolve(F.col("_b"), F.col("_ref")).alias("asset")).groupBy(key, "asset").agg(F.min("_at").alias("_at"))
    ordered = named.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_at", "asset"))).alias("_a"))
    return ordered.select(key, F.posexplode("_a").alias("place", "_x")).select(key, "place", F.col("_x.asset").alias("asset"))


def profile_links(pages: DataFrame, key: str, url: str, html: str, pattern: str) -> DataFrame:
    """(key, id, slug, label, link, cells): anchors whose href matches ``pattern`` (id, slug), the first of each id of a page.

    ``cells`` are the texts of the table row in which the anchor stands; none outside of tables.
    """
    rows = pages.select(key, url, page_parts("links", "base")(html).alias("p"))
    each = rows.select(key, base_url(F.col(url), F.col("p.base")).alias("_b"), F.posexplode("p.links").alias("_at", "l"))
    found = each.withColumns({"id": F.regexp_extract("l.href", pattern, 1), "slug": F.regexp_extract("l.href", pattern, 2)}).where("id <> ''")
    first = found.groupBy(key, "id").agg(F.min_by(F.struct("slug", "_b", "l"), "_at").alias("x"))
    return first.select(key, "id", "x.slug", F.col("x.l.label").alias("label"), resolve(F.col("x._b"), F.col("x.l.href")).alias("link"), F.col("x.l.cells").alias("cells"))


def embedded_json(scripts: Column, script_id: str) -> Column:
    """The text of the first script element with an id, null where there is none or it is no JSON."""
    body = F.try_element_at(F.transform(F.filter(scripts, lambda x: x["id"] == script_id), lambda x: x["body"]), F.lit(1))
    return F.when(F.try_parse_json(body).isNotNull(), body)
