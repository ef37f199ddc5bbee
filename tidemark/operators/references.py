"""References of pages and style sheets: list, resolve, find missing ones, rewrite."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import refs, urls
from tidemark.operators import skew
from tidemark.session import materialise


def page_refs(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """``kind, pos, raw``: every reference of a page, attributes before style blocks."""
    return pages.select(*keep, F.inline(refs.page_references(F.col(html_col)))).select(
        *keep, "pos", "kind", "raw"
    )


def css_refs(sheets: DataFrame, keep: list[str], css_col: str = "css") -> DataFrame:
    return sheets.select(*keep, F.inline(refs.sheet_references(F.col(css_col)))).select(
        *keep, "pos", "raw"
    )


def resolve(found: DataFrame, base_col: str, raw_col: str = "raw", out: str = "url") -> DataFrame:
    """Add the absolute URL; references that are never captured are left out."""
    return found.withColumn(out, urls.resolve(F.col(raw_col), F.col(base_col))).filter(
        F.col(out).isNotNull()
    )


def missing_refs(
    resolved: DataFrame, url_map: DataFrame, keep: list[str], scope: list[str] | None = None, split_hot: bool = False
) -> DataFrame:
    """Resolved URLs without a local copy, unique and sorted per page.

    ``scope`` names the columns (``capture_id``) inside which a URL counts as saved: what
    one capture saved does not help another. Made distinct before the join; the map has each
    URL once per scope. A URL every page links to skews only the stream side of the anti
    join, which adaptive execution splits; with ``split_hot`` such URLs are found beforehand and not shuffled.
    """
    on = [*(scope or []), "url"]
    columns = list(dict.fromkeys([*(scope or []), *keep, "url"]))
    wanted = resolved.select(*columns).distinct()
    known = url_map.select(*on).distinct()
    if split_hot:
        left = skew.join_unique(materialise(wanted, "wanted"), known, on, "left_anti")
    else:
        left = wanted.join(known, on, "left_anti")
    return left.select(*columns).orderBy(*columns)


def missing_urls(
    resolved: DataFrame, url_map: DataFrame, scope: list[str] | None = None
) -> DataFrame:
    """Missing URLs over all pages with the number of references to each.

    Counted first, so both sides of the join hold every URL once: nothing can skew it.
    """
    on = [*(scope or []), "url"]
    counted = resolved.groupBy(*on).agg(F.count(F.lit(1)).alias("referencias"))
    return counted.join(url_map.select(*on).distinct(), on, "left_anti")


REWRITTEN = T.StructType().add("text", T.StringType()).add("error", T.StringType())


def checked(rewriter: Callable[..., str], text: str | None, *rest: object) -> dict[str, str | None]:
    """The rewritten text, or the text as it was with what went wrong."""
    if text is None:
        return {"text": None, "error": None}
    try:
        return {"text": rewriter(text, *rest), "error": None}
    except Exception as failure:  # one bad document is reported and fails no others
        return {"text": text, "error": str(failure) or type(failure).__name__}


REWRITTEN_ARROW = pa.struct([("text", pa.string()), ("error", pa.string())])

# As many documents and maps are Python objects at once, however long an Arrow batch is.
DOCUMENTS_AT_ONCE = 64


def _checked_slices(rewriter: Callable[..., str], columns: tuple[pa.Array, ...]) -> Iterator[pa.Array]:
    """The results of a batch, some documents at a time; the last column is the map of references."""
    for at in range(0, len(columns[0]), DOCUMENTS_AT_ONCE):
        texts, *rest, maps = [c.slice(at, DOCUMENTS_AT_ONCE).to_pylist() for c in columns]
        known = [dict(m or ()) for m in maps]
        done = [checked(rewriter, *row) for row in zip(texts, known, *rest)]
        yield pa.array(done, REWRITTEN_ARROW)


@F.arrow_udf(REWRITTEN)
def _rewrite_pages(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    from tidemark.functions.markup import rewrite_page

    for columns in batches:
        yield from _checked_slices(rewrite_page, columns)


@F.arrow_udf(REWRITTEN)
def _rewrite_sheets(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    from tidemark.functions.markup import rewrite_css

    for columns in batches:
        yield from _checked_slices(rewrite_css, columns)


def _put(joined: DataFrame, done: Column, text_col: str, errors: str | None) -> DataFrame:
    """The rewritten text in place; the error in a column of its own, or as a failure of the job."""
    made = joined.withColumn("_hecho", done)
    text, error = F.col("_hecho.text"), F.col("_hecho.error")
    if errors is None:
        made = made.withColumn(text_col, F.when(error.isNotNull(), F.raise_error(error)).otherwise(text))
    else:
        made = made.withColumn(text_col, text).withColumn(errors, error)
    return made.drop("_hecho", "mapa")


def _with_maps(
    docs: DataFrame, found: DataFrame, url_map: DataFrame, key: str, base_col: str, scope: list[str], split_hot: bool = False
) -> DataFrame:
    """Documents with ``mapa``: raw reference -> local path, within their own scope.

    The list is bounded by what one document refers to.
    """
    ids = [*scope, key]
    wanted = resolve(found, base_col, out="_url").select(*ids, "raw", F.col("_url").alias("url")).distinct()
    local = url_map.select(*scope, "url", "local")
    if split_hot:
        known = skew.join_unique(materialise(wanted, "wanted"), local, [*scope, "url"])
    else:
        known = wanted.join(local, [*scope, "url"])
    pairs = F.collect_set(F.struct("raw", "local"))
    maps = known.groupBy(*ids).agg(F.map_from_entries(pairs).alias("mapa"))
    return docs.join(maps, ids, "left")


def rewrite(
    pages: DataFrame, url_map: DataFrame, key: str = "page_id", base_col: str = "url",
    html_col: str = "html", scope: list[str] | None = None, errors: str | None = None, split_hot: bool = False,
) -> DataFrame:
    """Pages with captured references made local. ``url_map`` has each URL once per scope.

    A map of several captures needs ``scope=["capture_id"]``, a column of both tables.
    Content-security tags are dropped and a base tag for the page's host is put first. With ``errors`` a page that
    cannot be rewritten stays as it was and says why in a column of that name; without, it fails the job. ``split_hot`` writes the references once and joins
    those to URLs that very many pages name by broadcast (``skew.join_unique``).
    """
    within = scope or []
    found = page_refs(pages, [*within, key, base_col], html_col)
    host = F.regexp_extract(base_col, "^[A-Za-z][^:]*://([^/?#]*)", 1)
    host = F.when(host == "", "nohost").otherwise(host)
    joined = _with_maps(pages, found, url_map, key, base_col, within, split_hot)
    return _put(joined, _rewrite_pages(F.col(html_col), host, F.col("mapa")), html_col, errors)


def rewrite_css(
    sheets: DataFrame, url_map: DataFrame, key: str, base_col: str = "url", css_col: str = "css",
    scope: list[str] | None = None, errors: str | None = None,
) -> DataFrame:
    within = scope or []
    found = css_refs(sheets, [*within, key, base_col], css_col)
    joined = _with_maps(sheets, found, url_map, key, base_col, within)
    return _put(joined, _rewrite_sheets(F.col(css_col), F.col("mapa")), css_col, errors)


def is_style_sheet(mime: Column, relpath: Column) -> Column:
    kind = F.lower(F.trim(F.substring_index(F.coalesce(mime, F.lit("")), ";", 1)))
    return (kind == "text/css") | F.lower(relpath).endswith(".css")


def iframe_manifest(frames: DataFrame) -> DataFrame:
    """Frames without their HTML; same-origin ones that had any get a file name."""
    name = F.format_string("iframes/iframe_%03d.html", F.coalesce("idx", F.lit(0)))
    kept = F.col("same_origin") & F.col("html").isNotNull()
    return frames.withColumn("saved_html", F.when(kept, name)).drop("html")
