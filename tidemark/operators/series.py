"""Quote series: seeds looked back, densify over every day, forward and backward fill.

Quotes are ``fecha date, codigo string, moneda string, compra double, venta double, ord``,
where ``ord`` gives the order of first appearance. A currency holds at most one row per
day, so after the per-day aggregate no group is larger than the number of days asked for,
whatever share of the raw rows one currency has.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import calendar, fixed, gates

QUOTE_COLUMNS = ["fecha", "codigo", "moneda", "compra", "venta", "ord"]


def between_days(df: DataFrame, start: date, end: date) -> DataFrame:
    return df.filter(F.col("fecha").between(F.lit(start), F.lit(end)))


def needs_seed(
    quotes: DataFrame, start: date, end: date, selected: DataFrame | None = None
) -> DataFrame:
    """Currencies whose first row in the range has no ``compra``.

    With ``selected`` (``moneda``) a selected currency without rows needs one too, and
    only selected ones are looked at; without it only currencies present are.
    """
    first = (
        between_days(quotes, start, end)
        .groupBy("moneda")
        .agg(F.min_by(F.struct("compra"), "fecha").alias("primera"))
        .select("moneda", F.col("primera.compra").isNull().alias("sin_base"))
    )
    if selected is None:
        return first.filter("sin_base").select("moneda")
    return (
        selected.select("moneda").distinct()
        .join(first, "moneda", "left")
        .filter(F.coalesce("sin_base", F.lit(True)))
        .select("moneda")
    )


def _seed_aggregates(usable: Column) -> dict[str, Column]:
    """Latest compra, and latest venta, each with its day, among usable rows."""
    found = {}
    for measure in ("compra", "venta"):
        known = usable & F.col(measure).isNotNull()
        found[f"{measure}_dia"] = F.max(F.when(known, F.col("fecha")))
        found[f"{measure}_base"] = F.max_by(
            measure, F.when(known, F.struct("fecha", "ord", measure))
        )
    return found


def _seed_venta() -> Column:
    # The walk back stops at the day compra is found, so an older venta is not reached.
    reached = F.col("compra_dia").isNull() | (F.col("venta_dia") >= F.col("compra_dia"))
    return F.when(reached, F.col("venta_base"))


def find_seeds(
    history: DataFrame,
    start: date,
    lookback_days: int = fixed.RANGE_LOOKBACK_DAYS,
    skip_weekends: bool = False,
) -> DataFrame:
    """``moneda, compra, venta``: the last values known before ``start``.

    One map-side-combined aggregate over the look-back window. Of several values for a day
    the last in input order counts. A currency without any value in the window has no row.
    """
    window = between_days(
        history, start - timedelta(days=lookback_days), start - timedelta(days=1)
    )
    usable = ~calendar.is_weekend(F.col("fecha")) if skip_weekends else F.lit(True)
    return (
        window.groupBy("moneda")
        .agg(*[c.alias(n) for n, c in _seed_aggregates(usable).items()])
        .filter("compra_dia IS NOT NULL OR venta_dia IS NOT NULL")
        .select("moneda", F.col("compra_base").alias("compra"), _seed_venta().alias("venta"))
    )


def one_row_per_day(quotes: DataFrame, check_from: date | None = None) -> DataFrame:
    """Fold to one row per currency and day.

    Two rows for one day are an error, as reindexing such a series is. Days before
    ``check_from`` are only looked back on and may repeat: each measure then is its last
    known value in input order, as in ``find_seeds``.
    """

    def last_known(measure: str) -> Column:
        order = F.when(F.col(measure).isNotNull(), F.struct("ord", measure))
        return F.max_by(measure, order).alias(measure)

    checked = F.lit(True) if check_from is None else F.col("fecha") >= F.lit(check_from)
    return (
        quotes.groupBy("moneda", "fecha")
        .agg(
            F.min("codigo").alias("codigo"),
            last_known("compra"),
            last_known("venta"),
            F.min("ord").alias("ord"),
            F.count(F.lit(1)).alias("filas"),
        )
        # A filter, not a column: it has to survive column pruning.
        .filter(
            F.when(
                checked & (F.col("filas") > 1),
                F.raise_error(F.concat(F.lit("two quotes for one day: "), F.col("moneda"))),
            ).otherwise(F.lit(True))
        )
        .select(*QUOTE_COLUMNS)
    )


def fill(
    quotes: DataFrame,
    start: date,
    end: date,
    seeds: DataFrame | None = None,
    method: str = "both",
    enabled: bool = True,
) -> DataFrame:
    """Every day of the range for every currency present, gaps filled.

    ``method``: ``none`` leaves gaps, ``forward`` carries values on, ``both`` then also
    gives the days before the first value that (later) value. A seed stands for the day
    before ``start``; it is used when it has a ``compra``, and never for a currency that
    has no row in the range. ``enabled=False`` returns the raw rows.
    """
    in_range = between_days(quotes, start, end)
    if not enabled:
        return in_range.select(*QUOTE_COLUMNS)
    rows = one_row_per_day(in_range)
    if seeds is not None:
        base = seeds.filter(F.col("compra").isNotNull()).select(
            "moneda", F.col("compra").alias("compra_base"), F.col("venta").alias("venta_base")
        )
        rows = rows.join(base, "moneda", "left")
    return _write_days(_runs(rows), start, end, method)


def fill_with_seeds(
    quotes: DataFrame,
    start: date,
    end: date,
    lookback_days: int = fixed.RANGE_LOOKBACK_DAYS,
    skip_weekends: bool = False,
    method: str = "both",
) -> DataFrame:
    """Look seeds up in the rows before ``start`` and fill the range, in one pass.

    Range and look-back days come from one scan; the seed is worked out in the same
    per-currency window that fills, so no seed table is joined. A seed is used only where
    the first row of the range has no ``compra``.
    """
    window = between_days(quotes, start - timedelta(days=lookback_days), end)
    rows = one_row_per_day(window, check_from=start)
    inside = F.col("fecha") >= F.lit(start)
    usable = ~inside
    if skip_weekends:
        usable = usable & ~calendar.is_weekend(F.col("fecha"))
    whole = _whole_currency()
    first_row = F.min_by(F.struct("compra"), F.when(inside, F.col("fecha"))).over(whole)
    found = rows.select(
        *QUOTE_COLUMNS,
        first_row["compra"].isNull().alias("sin_base"),
        *[c.over(whole).alias(n) for n, c in _seed_aggregates(usable).items()],
    ).filter(inside)
    wanted = F.col("sin_base") & F.col("compra_base").isNotNull()
    based = found.select(
        *QUOTE_COLUMNS,
        F.when(wanted, F.col("compra_base")).alias("compra_base"),
        F.when(wanted, _seed_venta()).alias("venta_base"),
    )
    return _write_days(_runs(based), start, end, method)


def _whole_currency():
    return Window.partitionBy("moneda").orderBy("fecha").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )


def _runs(rows: DataFrame) -> DataFrame:
    """Reported rows with the day they hold until and the values known so far."""
    by_day = Window.partitionBy("moneda").orderBy("fecha")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, 0)
    whole = _whole_currency()
    bases = [c for c in ("compra_base", "venta_base") if c in rows.columns]
    return rows.select(
        "moneda", "fecha", "compra", "venta", *bases,
        F.first("codigo", True).over(whole).alias("codigo"),
        F.min("ord").over(whole).alias("ord"),
        F.lag("fecha").over(by_day).isNull().alias("es_primera"),
        F.date_sub(F.lead("fecha").over(by_day), 1).alias("hasta"),
        *[F.last(m, True).over(so_far).alias(f"{m}_previa") for m in ("compra", "venta")],
        *[F.first(m, True).over(whole).alias(f"{m}_primera") for m in ("compra", "venta")],
    )


def _write_days(runs: DataFrame, start: date, end: date, method: str) -> DataFrame:
    """One row per day: each reported row is carried to the day before the next one.

    The days come out of ``sequence`` after the windows, so the filled-up series itself is
    never joined, shuffled or sorted.
    """
    if method not in ("none", "forward", "both"):
        raise ValueError("method is none, forward or both")
    first_day = F.when(F.col("es_primera"), F.lit(start)).otherwise(F.col("fecha"))
    days = runs.withColumn(
        "dia", F.explode(F.sequence(first_day, F.coalesce("hasta", F.lit(end))))
    )

    def value(measure: str) -> Column:
        if method == "none":
            known = F.when(F.col("dia") == F.col("fecha"), F.col(measure))
            return known.alias(measure)
        options = [F.when(F.col("dia") >= F.col("fecha"), F.col(f"{measure}_previa"))]
        if f"{measure}_base" in runs.columns:
            options.append(F.col(f"{measure}_base"))
        if method == "both":
            options.append(F.col(f"{measure}_primera"))
        return F.coalesce(*options).alias(measure)

    return days.select(
        F.col("dia").alias("fecha"), "codigo", "moneda", value("compra"), value("venta"), "ord"
    )


def densify(quotes: DataFrame, start: date, end: date) -> DataFrame:
    """Every day for every currency present; days without a quote stay empty."""
    return fill(quotes, start, end, method="none")


def first_seen_order(quotes: DataFrame) -> DataFrame:
    """``moneda, ord``: the position a currency first appears at (its sort key)."""
    return quotes.groupBy("moneda").agg(F.min("ord").alias("ord"))


def ordered(series: DataFrame) -> DataFrame:
    """Output order: by date, then by first appearance."""
    return series.orderBy("fecha", "ord", "moneda")


def select_currencies(quotes: DataFrame, codes: list[str], code_col: str = "codigo") -> DataFrame:
    return quotes.filter(gates.selected(F.col(code_col), codes))
