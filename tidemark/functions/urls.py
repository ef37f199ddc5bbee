"""URL expressions: normalise, file extension, safe relative path, resolve."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import fixed


def normalise_url(url: Column) -> Column:
    """Without fragment (nor an empty query); the scheme in lower case."""
    bare = F.regexp_replace(F.regexp_replace(url, "(?s)#.*$", ""), r"\?$", "")
    scheme = F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    return F.concat(F.lower(scheme), F.substring(bare, F.length(scheme) + 1, F.length(bare)))


def mime_extension(mime: Column) -> Column:
    """Extension of a MIME type, parameters ignored; empty when it is not known."""
    kind = F.lower(F.trim(F.substring_index(mime, ";", 1)))
    known = F.create_map(*[F.lit(x) for pair in fixed.MIME_EXTENSIONS for x in pair])
    return F.coalesce(F.try_element_at(known, kind), F.lit(""))


def _unquote(path: Column) -> Column:
    # A percent sign that starts no escape, and every plus, stand for themselves.
    literal = F.regexp_replace(path, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(F.replace(literal, F.lit("+"), F.lit("%2B")))


def safe_relpath(url: Column, mime: Column) -> Column:
    """Relative file path for a captured URL.

    Host, then the decoded path with unsafe characters replaced; an extension by MIME type
    when the name has none; a short hash of the query before the extension.
    """
    rest = F.regexp_replace(url, "(?s)#.*$", "")
    query = F.regexp_extract(rest, r"(?s)^[^?]*\?(.*)$", 1)
    located = F.regexp_replace(F.regexp_replace(rest, r"(?s)\?.*$", ""), r"^[A-Za-z][A-Za-z0-9+.\-]*:", "")
    host = F.regexp_extract(located, "^//([^/]*)", 1)
    raw = F.regexp_replace(F.regexp_replace(located, "^//[^/]*", ""), ";[^/]*$", "")
    path = _unquote(F.when(raw == "", "/").otherwise(raw))
    path = F.when(path.endswith("/"), F.concat(path, F.lit("index"))).otherwise(path)
    path = F.replace(F.ltrim(path, F.lit("/")), F.lit(".."), F.lit("_"))
    path = F.regexp_replace(path, '[<>:"|?*]', "_")
    # Empty and "." segments vanish when the path is put together.
    path = F.array_join(F.filter(F.split(path, "/"), lambda s: ~s.isin("", ".")), "/")
    full = F.concat_ws("/", F.when(host == "", "nohost").otherwise(host), F.nullif(path, F.lit("")))
    folder = F.regexp_extract(full, "(?s)^(.*/)?[^/]*$", 1)
    name = F.substring_index(full, "/", -1)
    own = F.regexp_extract(name, r"(?s)^.+(\.[^.]+)$", 1)
    stem = F.substring(name, F.lit(1), F.length(name) - F.length(own))
    suffix = F.when(own != "", own).otherwise(mime_extension(mime))
    mark = F.when(query != "", F.concat(F.lit("__q"), F.substring(F.sha2(query, 256), 1, 12))).otherwise("")
    return F.concat(folder, stem, mark, suffix)


def skipped(value: Column) -> Column:
    """Anchors, mail links, scripts, inline data: nothing to capture."""
    low = F.lower(value)
    found = low.startswith(fixed.SKIPPED_SCHEMES[0])
    for start in fixed.SKIPPED_SCHEMES[1:]:
        found = found | low.startswith(start)
    return found


@F.pandas_udf(T.StringType())
def _resolve_any(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    from html import unescape
    from urllib.parse import urldefrag, urljoin

    skip = tuple(fixed.SKIPPED_SCHEMES)

    def resolve(raw: str | None, base: str | None) -> str | None:
        if raw is None or base is None:
            return None
        value = unescape(unescape(raw.strip()))
        if value.lower().startswith(skip):
            return None
        try:
            return urldefrag(urljoin(base, value)).url
        except ValueError:
            return value

    for raws, bases in batches:
        yield pd.Series([resolve(r, b) for r, b in zip(raws, bases)], dtype=object)


# Marked so that a filter on the result is not pushed below it, which would run it twice.
_resolve_any = _resolve_any.asNondeterministic()


def resolve(raw: Column, base: Column) -> Column:
    """Absolute URL of a reference on a page, without fragment; NULL for skipped ones.

    Absolute and root-relative references without entities or dot segments are resolved by
    expressions. Only the others are handed to Python, the rest go there as NULL.
    """
    value = F.trim(raw)
    plain = value.rlike(r"^(https?://[^\s&/]|/(?!/))[^\s&]*$") & ~value.contains("/.")
    origin = F.regexp_extract(base, r"^https?://[^/?#]+", 0)
    easy = plain & (origin != "")
    joined = F.when(value.startswith("/"), F.concat(origin, value)).otherwise(value)
    return (
        F.when(skipped(value), F.lit(None))
        .when(easy, normalise_url(joined))
        .otherwise(_resolve_any(F.when(~easy & ~skipped(value), raw), base))
    )
