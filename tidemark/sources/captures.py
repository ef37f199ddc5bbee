"""Captured responses and pages, and the jobs that turn them into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import clean, fixed, gates
from tidemark.operators import reshape, tables


def read_captures(spark: SparkSession, path: str, pattern: str = "*.html") -> DataFrame:
    """Capture files as ``path, requested_date, content``; the name ends in ddmmyyyy."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    day = F.regexp_extract("path", r"(\d{8})\.[A-Za-z]+$", 1)
    return files.select(
        "path",
        F.when(day != "", F.try_to_date(day, "ddMMyyyy")).alias("requested_date"),
        "content",
    )


def page_text(content: Column) -> Column:
    """UTF-8 text; bytes that are none become replacement characters and fail no job."""
    return F.make_valid_utf8(content.cast("string"))


def weighted_quotes(responses: DataFrame, keep: list[str]) -> DataFrame:
    """Response bytes to quotes: payload gate, table rows, currency codes.

    Responses with an error ``status`` give no rows.
    """
    text = gates.latin1(F.col("content"))
    passed = responses.filter(gates.payload_ok(F.col("content"), text))
    if "status" in responses.columns:
        passed = passed.filter(gates.http_ok(F.col("status")))
    pages = tables.page_tables(passed.select(*keep, text.alias("html")))
    return clean.iso_code(tables.flat_rows(pages, keep), "moneda")


def average_quotes(
    pages: DataFrame, keep: list[str], check_in_force: bool = False
) -> DataFrame:
    """Grid pages (``requested_date, html``) to quotes dated by the requested date.

    The date the page says it is in force for is only compared on request
    (``label_text`` is needed then); otherwise a stale page counts for the requested date.
    """
    usable = pages.filter(~gates.is_blocked(F.col("html")))
    if check_in_force:
        usable = usable.filter(gates.in_force(F.col("label_text"), F.col("requested_date")))
    carried = [*dict.fromkeys([*keep, "requested_date"])]
    scanned = tables.page_tables(usable.select(*carried, "html"))
    quotes = tables.grid_quotes(tables.class_grid(scanned, carried), carried)
    return clean.iso_code(quotes, "moneda", exact=True).withColumn("fecha", F.col("requested_date"))


def deposit_rates(
    captures: DataFrame,
    natural: bool = True,
    legal: bool = True,
    general: bool = True,
    keep: tuple[str, ...] = (),
) -> tuple[DataFrame | None, DataFrame]:
    """Deposit pages to long general rates and long rates by person; columns of ``keep`` go along.

    ``captures``: ``requested_date, label_text, html`` of the national page and
    ``label_foreign, html_foreign`` of the foreign one. A page in force for another date is
    skipped whole; an unconfirmed foreign page drops foreign data only.
    """
    in_force = captures.filter(gates.in_force(F.col("label_text"), F.col("requested_date")))
    confirmed = gates.foreign_confirmed(F.col("label_foreign"), F.col("requested_date"))
    sides = F.array(
        F.struct(F.lit(fixed.NATIONAL).alias("lado"), F.col("html").alias("html")),
        F.struct(F.lit(fixed.FOREIGN).alias("lado"), F.when(confirmed, F.col("html_foreign")).alias("html")),
    )
    expected = F.when(
        F.col("lado") == fixed.NATIONAL, gates.table_hits(F.col("html"), fixed.NATIONAL_IDS)
    ).otherwise(gates.table_hits(F.col("html"), fixed.FOREIGN_IDS))
    pages = (
        in_force.select(F.col("requested_date").alias("fecha"), *keep, F.inline(sides))
        .filter(F.col("html").isNotNull() & (expected > 0))
    )
    found = tables.logical_tables(tables.page_tables(pages), ["fecha", *keep, "lado"])
    # Each page only speaks for its own side.
    own = found.filter(F.col("tipo_moneda") == F.col("lado"))
    by_person = reshape.person_rates(own, ["fecha", *keep], natural, legal)
    return (reshape.general_rates(own, ["fecha", *keep]) if general else None), by_person
