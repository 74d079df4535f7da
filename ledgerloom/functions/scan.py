"""Literal terms in texts by one automaton, and string literals of scripts by a lexer.

Any number of terms is found in one pass over a text (Aho and Corasick), hits of different terms may
overlap.  Terms come as a table; they reach the tasks in slices of bounded size, a pass each.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StructType

from .dom import Page

SLICE_TERMS, SLICE_CHARS = 100_000, 16_000_000


def fold(text: str) -> str:
    """Lower case letter by letter, so that places stay: a letter whose lower case has several stays as it is."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


class Automaton:
    """Terms by number; equal terms after folding share their hits."""

    def __init__(self, terms: list[str], ignore_case: bool):
        self.ignore_case = ignore_case
        own: dict[str, list[int]] = {}
        for number, term in enumerate(terms):
            if term:
                own.setdefault(fold(term) if ignore_case else term, []).append(number)
        self.machine = ahocorasick.Automaton()
        for term, numbers in own.items():
            self.machine.add_word(term, (len(term), numbers))
        if own:
            self.machine.make_automaton()
        self.empty = not own

    def hits(self, text: str, overlapping: bool) -> Iterator[tuple[int, int]]:
        """(term, place) of every hit by its end; hits of one term overlap each other only if asked for."""
        if self.empty or not text:
            return
        free: dict[int, int] = {}
        for last, (size, numbers) in self.machine.iter(fold(text) if self.ignore_case else text):
            start = last - size + 1
            if not overlapping:
                if start < free.get(numbers[0], 0):
                    continue
                free[numbers[0]] = last + 1
            for number in numbers:
                yield number, start


def term_slices(terms: DataFrame | Iterable[str], most: int = SLICE_TERMS, chars: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Distinct non-empty terms (the first column of a table) in lists of bounded number and size."""
    if isinstance(terms, DataFrame):
        name = terms.columns[0]
        rows = terms.select(F.col(f"`{name}`").cast("string").alias("t")).where("t <> ''").distinct().toLocalIterator()
        found = (r.t for r in rows)
    else:
        found = iter(dict.fromkeys(t for t in terms if t))
    part, size = [], 0
    for t in found:
        if part and (len(part) == most or size + len(t) > chars):
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def _scan(df: DataFrame, columns: list[str], text: str, terms: list[str], ignore_case: bool, rows_of, more: str) -> DataFrame:
    """The ``columns`` of every row beside what ``rows_of`` makes of its text, as a stream of Arrow batches."""
    shared = df.sparkSession.sparkContext.broadcast(terms)
    kept = df.select(*columns)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), more])
    names = [*columns, *(x.split()[0] for x in more.split(", "))]
    kinds = [{"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[x.split()[1]] for x in more.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Automaton(shared.value, ignore_case)
        for batch in batches:
            at, out = [], []
            for i, body in enumerate(batch.column(len(columns)).to_pylist()):
                for row in rows_of(machine, shared.value, body or ""):
                    at.append(i)
                    out.append(row)
                if len(out) >= 20_000:
                    yield _beside(batch, at, out, names, kinds, len(columns))
                    at, out = [], []
            if out:
                yield _beside(batch, at, out, names, kinds, len(columns))

    return df.select(*columns, F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


def _beside(batch: pa.RecordBatch, at: list[int], out: list[tuple], names: list[str], kinds: list[pa.DataType], n: int) -> pa.RecordBatch:
    rows = pa.array(at, pa.int64())
    return pa.RecordBatch.from_arrays([*(batch.column(j).take(rows) for j in range(n)), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], names)


def _union(parts: list[DataFrame], otherwise: DataFrame) -> DataFrame:
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return otherwise if out is None else out


def term_hits(df: DataFrame, key: str, text: str, terms: DataFrame | Iterable[str], ignore_case: bool = False, overlapping: bool = False) -> DataFrame:
    """(key, term, offset) of every hit, offsets in characters from 0."""
    def rows(machine: Automaton, names: list[str], body: str):
        return ((names[n], at) for n, at in machine.hits(body, overlapping))

    parts = [_scan(df, [key], text, part, ignore_case, rows, "term string, offset long") for part in term_slices(terms)]
    return _union(parts, df.select(key, F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("offset")).limit(0))


def keyword_hits(df: DataFrame, key: str, text: str, needles: DataFrame | Iterable[str], zeros: bool = True, ignore_case: bool = False, overlapping: bool = False) -> DataFrame:
    """(key, needle, hits) of literal needles; with ``zeros`` a row for every needle, else only for those that occur."""
    def rows(machine: Automaton, names: list[str], body: str):
        counts: dict[int, int] = {}
        for n, _ in machine.hits(body, overlapping):
            counts[n] = counts.get(n, 0) + 1
        return ((names[n], counts.get(n, 0)) for n in (range(len(names)) if zeros else sorted(counts)))

    parts = [_scan(df, [key], text, part, ignore_case, rows, "needle string, hits int") for part in term_slices(needles)]
    return _union(parts, df.select(key, F.lit(None).cast("string").alias("needle"), F.lit(0).alias("hits")).limit(0))


def contains_any(df: DataFrame, text: str, targets: DataFrame | Iterable[str], ignore_case: bool = True) -> DataFrame:
    """The rows whose text holds any of the targets, each once, with all their columns."""
    def rows(machine: Automaton, names: list[str], body: str):
        return [(1,)] if next(machine.hits(body, True), None) else []

    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    slices = list(term_slices(targets))
    parts = [_scan(numbered, numbered.columns, text, part, ignore_case, rows, "_hit int").drop("_hit") for part in slices]
    if not parts:
        return df.limit(0)
    found = _union(parts, numbered)
    return (found if len(parts) == 1 else found.dropDuplicates(["_row"])).drop("_row")


def keyword_context(df: DataFrame, key: str, text: str, terms: DataFrame | Iterable[str], before: int, after: int, ignore_case: bool = False) -> DataFrame:
    """(key, term, offset, context): every hit with ``before`` characters before it and ``after`` behind it."""
    def rows(machine: Automaton, names: list[str], body: str):
        for n, at in machine.hits(body, False):
            yield names[n], at, body[max(at - before, 0) : at + len(names[n]) + after]

    parts = [_scan(df, [key], text, part, ignore_case, rows, "term string, offset long, context string") for part in term_slices(terms)]
    nothing = df.select(key, F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("offset"), F.lit(None).cast("string").alias("context")).limit(0)
    return _union(parts, nothing)


def routes_near(df: DataFrame, key: str, script: str, terms: DataFrame | Iterable[str], before: int = 1800, after: int = 3500, longest: int = 300) -> DataFrame:
    """(key, term, route): the distinct literals of a script that begin with a slash and lie in the context of a term, whatever its case."""
    def rows(machine: Automaton, names: list[str], body: str):
        hits = list(machine.hits(body, False))
        routes = [(at, value) for at, kind, value in literals(body) if kind == "plain" and value.startswith("/") and len(value) <= longest] if hits else []
        found = {(names[n], value) for n, place in hits for at, value in routes if place - before <= at and at + len(value) + 2 <= place + len(names[n]) + after}
        return sorted(found)

    parts = [_scan(df, [key], script, part, True, rows, "term string, route string") for part in term_slices(terms)]
    return _union(parts, df.select(key, F.lit(None).cast("string").alias("term"), F.lit(None).cast("string").alias("route")).limit(0))


# What a script is made of.  A slash begins a regular expression unless a value stands before it.
_TOKEN = re.compile(r"""
    (?P<blank>\s+) | (?P<comment>//[^\n]*|/\*.*?(?:\*/|\Z)) | (?P<text>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*') | (?P<tick>`) |
    (?P<word>[\w$]+) | (?P<slash>/) | (?P<open>\{) | (?P<close>\}) | (?P<plus>\+\+|--|\+=?) | (?P<value>[)\]]) | (?P<other>.)
""", re.X | re.S)
_REGEX = re.compile(r"/(?:[^/\\\n\[]|\\.|\[(?:[^\]\\\n]|\\.)*\])+/\w*")
_PIECE = re.compile(r"(?:[^`\\$]|\\.|\$(?!\{))*", re.S)
#: Words after which a slash begins a regular expression.
_BEFORE_VALUE = set("return typeof case in of delete void throw new else do instanceof yield await".split())
_ESCAPE = re.compile(r"\\(u\{([0-9a-fA-F]{1,6})\}|u([0-9a-fA-F]{4})|x([0-9a-fA-F]{2})|\r\n|.)", re.S)
_NAMED = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "v": "\v", "0": "\0", "\n": "", "\r\n": "", "\u2028": "", "\u2029": ""}


def unescape(body: str) -> str:
    def one(m: re.Match) -> str:
        code = m[2] or m[3] or m[4]
        if code:
            return chr(int(code, 16)) if int(code, 16) < 0x110000 else m[0]
        return _NAMED.get(m[1], m[1])

    return _ESCAPE.sub(one, body) if "\\" in body else body


def literals(script: str) -> Iterator[tuple[int, str, str]]:
    """(offset, kind, value) of the string literals of a script, in the order of their ends.

    Kinds: ``plain``; ``joined`` for one that stands beside a plus; ``template`` for one with placeholders,
    whose value has ``${}`` in their place.  What stands in comments and regular expressions is none.
    """
    at, n = 0, len(script)
    value_before = False  # whether a slash here would divide
    plus_before = False
    waiting: tuple[int, str] | None = None  # a literal that waits for what comes next
    # open templates: (offset, pieces so far, whether a plus stood before); and the braces open in the innermost placeholder
    templates: list[tuple[int, list[str], bool]] = []
    braces: list[int] = []

    def piece() -> Iterator[tuple[int, str, str]]:
        """Read on in the innermost template."""
        nonlocal at, value_before, plus_before, waiting
        start, pieces, plus = templates[-1]
        m = _PIECE.match(script, at)
        pieces.append(unescape(m[0]))
        at = m.end()
        if script.startswith("${", at):
            at += 2
            braces.append(0)
            value_before = plus_before = False
            return
        templates.pop()
        if at >= n:
            return  # it never ends
        at += 1
        value_before = True
        if len(pieces) > 1:
            yield start, "template", "${}".join(pieces)
        elif plus:
            yield start, "joined", pieces[0]
        else:
            waiting = start, pieces[0]

    while at < n:
        m = _TOKEN.match(script, at)
        kind, token = m.lastgroup, m[0]
        if kind in ("blank", "comment"):
            at = m.end()
            continue
        if waiting:
            yield waiting[0], "joined" if kind == "plus" and token[:1] == "+" and token != "++" else "plain", waiting[1]
            waiting = None
        at = m.end()
        if kind == "text":
            if plus_before:
                yield m.start(), "joined", unescape(token[1:-1])
            else:
                waiting = m.start(), unescape(token[1:-1])
        elif kind == "tick":
            templates.append((m.start(), [], plus_before))
            yield from piece()
            plus_before = False
            continue
        elif kind == "slash" and not value_before:
            regex = _REGEX.match(script, m.start())
            if regex:
                at = regex.end()
                kind = "value"
        elif kind == "open" and braces:
            braces[-1] += 1
        elif kind == "close" and braces:
            if braces[-1] == 0:
                braces.pop()
                yield from piece()
                plus_before = False
                continue
            braces[-1] -= 1
        plus_before = kind == "plus" and token in ("+", "+=")
        value_before = kind in ("text", "value", "close") or (kind == "word" and token not in _BEFORE_VALUE) or token in ("++", "--")
    if waiting:
        yield waiting[0], "plain", waiting[1]


@pandas_udf(ArrayType(StructType().add("script", "integer").add("offset", "integer").add("kind", "string").add("value", "string")))
def script_literals(x: pd.Series) -> pd.Series:
    """String literals of a page's inline scripts."""
    return x.map(lambda t: [
        {"script": i, "offset": at, "kind": kind, "value": value}
        for i, (_, _, body) in enumerate(Page(t).scripts) for at, kind, value in literals("".join(body))
    ])


def routes(found: Column, allow: str, block: str, longest: int) -> Column:
    """The distinct routes among ``script_literals``, in their order.

    A route is a whole literal that begins with a slash, matches ``allow`` but not ``block``, has no
    placeholder or brace and at most ``longest`` characters.
    """
    def is_route(x: Column) -> Column:
        v = x["value"]
        return (x["kind"] == "plain") & F.startswith(v, F.lit("/")) & v.rlike(allow) & ~v.rlike(block) & ~v.rlike(r"[{}]") & (F.length(v) <= longest)

    return F.array_distinct(F.transform(F.filter(found, is_route), lambda x: x["value"]))


def route_candidates(pages: DataFrame, html: str, allow: str, block: str, longest: int) -> DataFrame:
    """The columns of ``pages`` but for the page itself, and each ``route`` of its inline scripts once."""
    rest = [c for c in pages.columns if c != html]
    found = pages.select(*rest, script_literals(html).alias("_l"))
    return found.select(*rest, F.explode(routes(F.col("_l"), allow, block, longest)).alias("route"))
