"""Calendar tables: date spines, holidays, business days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import calendar


def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day of the closed range, ``fecha date``."""
    if end < start:
        raise ValueError("the end date must not be before the start date")
    days = (end - start).days + 1
    return spark.range(days, numPartitions=1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("fecha")
    )


def spine_of(df: DataFrame, day_col: str) -> DataFrame:
    """Every day between the first and the last one of a column.

    The bounds come from a map-side aggregate, so only one row is shuffled per task.
    """
    day = F.col(day_col).cast("date")
    return (
        df.agg(F.min(day).alias("ini"), F.max(day).alias("fin"))
        .filter(F.col("ini").isNotNull())
        .select(F.explode(F.sequence("ini", "fin")).alias("fecha"))
    )


def holidays(years: DataFrame, year_col: str = "anio") -> DataFrame:
    """``anio, fecha`` of every national holiday of the given years."""
    return (
        years.select(F.col(year_col).cast("int").alias("anio"))
        .distinct()
        .select("anio", F.explode(calendar.holidays_of(F.col("anio"))).alias("fecha"))
    )


def holiday_table(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    years = spark.range(first_year, last_year + 1, numPartitions=1)
    return holidays(years.withColumnRenamed("id", "anio"))


def business_days(
    spine: DataFrame, custom_holidays: DataFrame | None = None, skip_weekends: bool = True
) -> DataFrame:
    """Spine without weekends and holidays.

    National holidays are an expression over the date. A custom calendar (``fecha``)
    is removed with an anti join.
    """
    days = spine.filter(~calendar.is_weekend(F.col("fecha"))) if skip_weekends else spine
    if custom_holidays is None:
        return days.filter(~calendar.is_holiday(F.col("fecha")))
    return days.join(custom_holidays.select("fecha").distinct(), "fecha", "left_anti")
