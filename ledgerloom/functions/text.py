"""Text normalisers.  Unicode forms have no built-in function, so they run as Arrow-batched helpers
over distinct values where a column repeats; everything else is JVM expressions."""

from __future__ import annotations

import html
import re
import unicodedata
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


def _each(series: pd.Series, f) -> pd.Series:
    """f over the distinct values of a batch; null stays null."""
    known = {v: f(v) for v in series.dropna().unique()}
    return pd.Series([known.get(v) for v in series], dtype=object)


@pandas_udf(StringType())
def nfkd_strip(x: pd.Series) -> pd.Series:
    """NFKD without U+0300-036F."""
    return _each(x, lambda v: v if v.isascii() else "".join(c for c in unicodedata.normalize("NFKD", v) if not 0x300 <= ord(c) <= 0x36F))


@pandas_udf(StringType())
def casefold_strip(x: pd.Series) -> pd.Series:
    """NFKD without combining marks, case-folded (sharp s becomes ss)."""
    return _each(x, lambda v: v.lower() if v.isascii() else "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)).casefold())


@pandas_udf(StringType())
def ascii_only(x: pd.Series) -> pd.Series:
    """Entities decoded, NFKD, letters that have no ASCII form deleted."""
    return _each(x, lambda v: unicodedata.normalize("NFKD", html.unescape(v)).encode("ascii", "ignore").decode())


@pandas_udf(StringType())
def nfkc_casefold(x: pd.Series) -> pd.Series:
    return _each(x, lambda v: unicodedata.normalize("NFKC", v).casefold().replace("’", "'"))


@pandas_udf(StringType())
def nfkc(x: pd.Series) -> pd.Series:
    return _each(x, lambda v: unicodedata.normalize("NFKC", v))


@pandas_udf(StringType())
def unescape(x: pd.Series) -> pd.Series:
    return _each(x, html.unescape)


_REFERENCE = re.compile("&(#[0-9]+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)?")


def by_reference(text: str, ended, other) -> str:
    """The text with ``ended`` of every known reference that ends in a semicolon, and with ``other`` in the place of any other ampersand."""

    def one(m: re.Match) -> str:
        name = m[1]
        if name and (name[0] == "#" or name in html5):
            return ended(m[0])
        return other + m[0][1:]

    return _REFERENCE.sub(one, text)


@pandas_udf(StringType())
def unescape_ended(x: pd.Series) -> pd.Series:
    """Only references that end in a semicolon are decoded, as in XML."""
    return _each(x, lambda v: by_reference(v, html.unescape, "&"))


def without_marks(x: Column) -> Column:
    """NFKD without combining marks; plain ASCII never leaves the JVM as text."""
    plain = x.rlike(r"^[\x00-\x7F]*$")
    return F.when(plain, x).otherwise(nfkd_strip(F.when(~plain, x)))


def norm_surface(x: Column) -> Column:
    """Lower case, ``&`` as ``and``, other than a-z0-9 as one space; undecomposable letters become a space."""
    low = F.replace(F.lower(without_marks(x)), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(low, "[^a-z0-9]+", " "))


def norm_casefold(x: Column) -> Column:
    return F.trim(F.regexp_replace(casefold_strip(x), "[^a-z0-9]+", " "))


def ascii_tokens(x: Column) -> Column:
    """Sorted distinct lower-case tokens; undecomposable letters are deleted, not split."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(ascii_only(x)), F.lit("[a-z0-9]+"), F.lit(0))))


def unicode_tokens(x: Column) -> Column:
    """Sorted word tokens with their marks (repeated tokens stay)."""
    return F.array_sort(F.regexp_extract_all(nfkc_casefold(x), F.lit(r"(?U)\w+"), F.lit(0)))


def slugify(x: Column) -> Column:
    slug = F.regexp_replace(F.regexp_replace(F.lower(ascii_only(x)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("x"))


def file_safe(x: Column) -> Column:
    return F.regexp_replace(x, "[^A-Za-z0-9._-]+", "_")


def club_key(x: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(nfkc(x), r"\s+", " ")))


def html_text(x: Column, ended: bool = False) -> Column:
    """Line breaks as spaces, tags dropped, entities decoded, spaces collapsed.

    Old entities without a semicolon (``&amp``) are decoded too, as browsers do; with ``ended`` they stay as they are.
    """
    flat = F.regexp_replace(F.regexp_replace(x, r"(?i)<br\s*/?>", " "), "<[^>]*>", "")
    return F.trim(F.regexp_replace((unescape_ended if ended else unescape)(flat), r"[\s ]+", " "))


def name_similarity(a: Column, b: Column) -> Column:
    """Best of edit, token and containment similarity; diagnostic only.  1 if equal, 0 if one is empty."""
    longest, shortest = F.greatest(F.length(a), F.length(b)), F.least(F.length(a), F.length(b))
    edit = F.lit(1.0) - F.levenshtein(a, b) / longest
    ta, tb = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    tokens = F.size(F.array_intersect(ta, tb)) / F.size(F.array_union(ta, tb))
    within = F.when(F.contains(a, b) | F.contains(b, a), shortest / longest).otherwise(0.0)
    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).otherwise(F.greatest(edit, tokens, within))


def token_subset(lookups: Column, full: Column) -> Column:
    """Some non-empty lookup token array lies within the non-empty full one."""
    return (F.size(full) > 0) & F.exists(lookups, lambda x: (F.size(x) > 0) & (F.size(F.array_except(x, full)) == 0))


def surrogate_key(prefix: str, kind: Column, value: Column) -> Column:
    """prefix-kind-v1- and 24 hex digits of sha256(kind|value)."""
    digest = F.sha2(F.concat_ws("|", kind, value.cast("string")), 256)
    return F.concat(F.lit(prefix + "-"), kind, F.lit("-v1-"), F.substring(digest, 1, 24))


# Month names by which pages give dates.
ITALIAN_MONTHS = "gen feb mar apr mag giu lug ago set ott nov dic".split()
ENGLISH_MONTHS = "january february march april may june july august september october november december".split()
LONG_ITALIAN_MONTHS = "gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre".split()


def _month(name: Column, names: list[str]) -> Column:
    return F.create_map(*[F.lit(x) for i, m in enumerate(names, 1) for x in (m, i)])[name]


def make_day(day: Column, month: Column, year: Column) -> Column:
    """A date, or null where the calendar has no such day."""
    return F.try_to_date(F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def localized_dates(text: Column) -> Column:
    """Sorted distinct days of all ``Nato il D mon YYYY`` in a text (accents dropped first)."""
    found = F.regexp_extract_all(F.lower(without_marks(text)), F.lit(r"nat[oa] il\s+(\d{1,2}\s+[a-z]{3}[a-z]*\s+\d{4})"), F.lit(1))

    def day(x: Column) -> Column:
        p = F.split(x, r"\s+")
        return make_day(p[0], _month(F.substring(p[1], 1, 3), ITALIAN_MONTHS), p[2])

    return F.array_sort(F.array_distinct(F.filter(F.transform(found, day), lambda d: d.isNotNull())))


def human_date(text: Column) -> Column:
    """``D month YYYY`` with full English or Italian month names."""
    low = F.lower(F.trim(text))
    part = [F.regexp_extract(low, r"^(\d{1,2})\s+([a-z]+)\s+(\d{4})$", i) for i in (1, 2, 3)]
    month = F.coalesce(_month(part[1], ENGLISH_MONTHS), _month(part[1], LONG_ITALIAN_MONTHS))
    return F.when(month.isNotNull(), make_day(part[0], month, part[2]))


def iso_day(value: Column, precision: Column | None = None) -> Column:
    """The day of a plain date or signed ISO instant; null unless the precision is a day (11)."""
    day = F.try_to_date(F.nullif(F.regexp_extract(value, r"^\+?(\d{4}-\d{2}-\d{2})(?:T.*)?$", 1), F.lit("")), "yyyy-MM-dd")
    return day if precision is None else F.when(precision == 11, day)


def day_state(value: Column, precision: Column) -> Column:
    """Why ``iso_day`` gives a day or none: DAY, OTHER_PRECISION, NO_DATE, MISSING."""
    return F.when(value.isNull(), "MISSING").when(F.coalesce(precision != 11, F.lit(True)), "OTHER_PRECISION").when(iso_day(value).isNull(), "NO_DATE").otherwise("DAY")


def valid_full_date(value: Column, first: int = 1940, last: int = 2010) -> Column:
    day = iso_day(value)
    return F.coalesce(F.year(day).between(first, last), F.lit(False))


def row_id(own: Column, text: Column) -> Column:
    """A digits-only id, else the SHA-1 of the record's canonical JSON."""
    return F.coalesce(F.when(own.cast("string").rlike(r"^\d+$"), own.cast("string")), F.sha1(text))


def utc_day(seconds: Column) -> Column:
    """The UTC day of Unix seconds, whatever the session's time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))


def domain_counts(df: DataFrame, texts: list[Column], top: int = 30) -> DataFrame:
    """(host, n): hosts of the distinct urls in any of the texts, the ``top`` most frequent ones."""
    found = F.concat(*[F.regexp_extract_all(t, F.lit(r"https?://[^\s\"'<>)]+"), F.lit(0)) for t in texts])
    urls = df.select(F.explode(F.array_distinct(found)).alias("url")).distinct()
    hosts = urls.select(F.lower(F.regexp_extract("url", r"^https?://([^/?#:]+)", 1)).alias("host")).groupBy("host").agg(F.count("*").alias("n"))
    return hosts.orderBy(F.desc("n"), "host").limit(top)
