"""What happened on each date, and what was exported."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import calendar, gates

STATUSES = ["fin de semana", "feriado", "error", "no vigente", "sin datos", "ok"]


def capture_facts(captures: DataFrame) -> DataFrame:
    """Fold captures (``requested_date, label_text, failed, n_rows``) to one row per date.

    Where captures tell their ``attempt``, only those of a date's last one count.
    """
    effective = gates.effective_date(F.col("label_text"))
    stale = ~gates.in_force(F.col("label_text"), F.col("requested_date"))
    tried = [c for c in ["attempt"] if c in captures.columns]
    facts = captures.groupBy(F.col("requested_date").alias("fecha"), *tried).agg(
        F.max("failed").alias("fallo"),
        calendar.format_dmy(F.max(F.when(stale, calendar.parse_dmy(effective)))).alias("vigente_al"),
        F.sum("n_rows").alias("filas"),
    )
    if not tried:
        return facts
    last = F.max(F.struct("attempt", "fallo", "vigente_al", "filas")).alias("ultimo")
    return facts.groupBy("fecha").agg(last).select("fecha", "ultimo.fallo", "ultimo.vigente_al", "ultimo.filas")


def date_status(
    spine: DataFrame, facts: DataFrame, skip_weekends: bool = True, holiday_year: int | None = None
) -> DataFrame:
    """Exactly one status for every date of the spine; the first that applies wins.

    ``facts`` has one row per date (``fecha, fallo, vigente_al, filas``).
    """
    day = F.col("fecha")
    weekend = calendar.is_weekend(day) if skip_weekends else F.lit(False)
    holiday = (
        calendar.is_holiday(day) if holiday_year is None else calendar.is_holiday_in(day, holiday_year)
    )
    status = (
        F.when(weekend, "fin de semana")
        .when(holiday, "feriado")
        .when(F.col("fallo"), "error")
        .when(F.col("vigente_al").isNotNull(), "no vigente")
        .when(F.coalesce("filas", F.lit(0)) == 0, "sin datos")
        .otherwise("ok")
    )
    return spine.join(facts, "fecha", "left").select(
        "fecha",
        status.alias("estado"),
        F.when(status == "no vigente", F.col("vigente_al")).alias("vigente_al"),
        F.when(status == "ok", F.col("filas")).alias("filas"),
    )


def status_counts(statuses: DataFrame) -> DataFrame:
    return statuses.groupBy("estado").agg(F.count(F.lit(1)).alias("dias"))


def run_summary(
    rows: DataFrame, output_col: str = "salida", requested: DataFrame | None = None
) -> DataFrame:
    """Rows per output and date, and whether there was anything to write.

    ``requested`` lists the outputs and dates asked for; those without rows are ``no_rows``.
    """
    keys = [output_col, "fecha"]
    counted = rows.select(*keys, F.lit(1).alias("_n"))
    if requested is not None:
        counted = counted.unionByName(requested.select(*keys, F.lit(0).alias("_n")))
    filas = F.sum("_n")
    return counted.groupBy(*keys).agg(
        filas.alias("filas"), F.when(filas > 0, "written").otherwise("no_rows").alias("accion")
    )
