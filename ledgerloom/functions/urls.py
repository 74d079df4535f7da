"""Resolution of references against a base url (RFC 3986, section 5), in built-in functions alone."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the standard's pattern of the five components.
_PARTS = r"(?s)^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?$"
_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*$"


class Reference(NamedTuple):
    """Components of a reference; an absent one is null, an empty one is not."""

    scheme: Column
    authority: Column
    path: Column
    query: Column
    fragment: Column


def split(ref: Column) -> Reference:
    def part(group: int, marked: int) -> Column:
        """A component is there if its mark is."""
        return F.when(F.regexp_extract(ref, _PARTS, marked) != "", F.regexp_extract(ref, _PARTS, group))

    scheme = part(2, 1)
    named = scheme.rlike(_SCHEME)
    # what stands before the first colon is only a scheme if it looks like one, else part of the path
    path = F.concat(F.when(named, "").otherwise(F.coalesce(F.regexp_extract(ref, _PARTS, 1), F.lit(""))), F.regexp_extract(ref, _PARTS, 5))
    return Reference(F.when(named, scheme), part(4, 3), path, part(7, 6), part(9, 8))


def remove_dots(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments; ``..`` at the root goes, a last dot segment leaves a slash."""
    rooted = F.startswith(path, F.lit("/"))
    segments = F.split(F.when(rooted, F.substr(path, F.lit(2))).otherwise(path), "/", -1)
    last = F.element_at(segments, -1)
    kept = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(s == ".", done).otherwise(F.array_append(done, s)))
    kept = F.when(last.isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept)
    return F.concat(F.when(rooted, "/").otherwise(""), F.array_join(kept, "/"))


def join(parts: Reference) -> Column:
    def marked(before: str, part: Column, after: str = "") -> Column:
        return F.when(part.isNull(), "").otherwise(F.concat(F.lit(before), part, F.lit(after)))

    return F.concat(marked("", parts.scheme, ":"), marked("//", parts.authority), parts.path, marked("?", parts.query), marked("#", parts.fragment))


def resolve(base: Column, ref: Column) -> Column:
    """The target of ``ref`` on a page whose base url is ``base``; null if either is null.

    White space around a reference, and line ends and tabs inside it, go, as browsers have it.
    """
    b, r = split(base), split(F.regexp_replace(F.trim(F.regexp_replace(ref, "[\\t\\r\\n]", "")), "^[\\x00-\\x20]+|[\\x00-\\x20]+$", ""))
    folder = F.regexp_extract(b.path, "(?s)^(.*/)?[^/]*$", 1)
    merged = F.when(b.authority.isNotNull() & (b.path == ""), F.concat(F.lit("/"), r.path)).otherwise(F.concat(folder, r.path))
    own, placed, empty = r.scheme.isNotNull(), r.authority.isNotNull(), r.path == ""
    path = F.when(own | placed | F.startswith(r.path, F.lit("/")), remove_dots(r.path)).when(empty, b.path).otherwise(remove_dots(merged))
    target = Reference(
        F.coalesce(r.scheme, b.scheme),
        F.when(own | placed, r.authority).otherwise(b.authority),
        path,
        F.when(own | placed | ~empty, r.query).otherwise(F.coalesce(r.query, b.query)),
        r.fragment,
    )
    return F.when(base.isNotNull() & ref.isNotNull(), join(target))


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(url, "(?s)#.*$", "")
