"""Text clean-up: amounts, rates, currency names, ISO codes, bucket names, keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import calendar, fixed

# What counts as a number. Texts such as "nan", "inf" or "1_000" are not values.
WHITE_SPACE = " \t\n\r\x0b\x0c\u00a0"
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip(text: Column) -> Column:
    """Drop white space, no-break space included, from both ends."""
    return F.trim(text, F.lit(WHITE_SPACE))


def to_number(text: Column) -> Column:
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def clean_amount(text: Column) -> Column:
    """Quote text to double; NULL for missing marks and for anything unreadable."""
    tidy = strip(text)
    number = to_number(strip(F.replace(tidy, F.lit(","), F.lit(""))))
    return F.when(~tidy.isin(fixed.AMOUNT_MISSING), number)


def clean_rate(text: Column) -> Column:
    """Struct ``valor`` (double) and ``valor_raw`` (the text, kept when unreadable)."""
    tidy = strip(text)
    number = to_number(F.translate(tidy, ", ", ""))
    present = ~tidy.isin(fixed.RATE_MISSING)
    return F.struct(
        F.when(present, number).alias("valor"),
        F.when(present & number.isNull(), tidy).alias("valor_raw"),
    )


def normalise_currency(name: Column, exact: bool = False) -> Column:
    """The North American dollar under its usual name.

    ``exact`` compares as written; otherwise case and outer blanks do not matter.
    """
    if exact:
        return F.when(name == fixed.USD_ALIAS, fixed.USD_NAME).otherwise(name)
    tidy = strip(name)
    return F.when(F.lower(tidy) == fixed.USD_ALIAS.lower(), fixed.USD_NAME).otherwise(tidy)


def values_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small constant table the optimiser knows the size of."""

    def literal(value) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, (bool, int, float)):
            return str(value).lower()
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({schema})")


def iso_code(df: DataFrame, name_col: str, out: str = "codigo", exact: bool = False) -> DataFrame:
    """Add the ISO code of a currency name; unknown names get ``???``.

    The dimension is a constant of 28 rows, so broadcasting it is always safe.
    """
    dim = values_table(df.sparkSession, fixed.ISO_CODES, "iso_nombre, iso_codigo")
    key = F.col(name_col)
    if not exact:
        dim = dim.withColumn("iso_nombre", F.lower("iso_nombre"))
        key = F.lower(strip(key))
    return (
        df.join(F.broadcast(dim), key == F.col("iso_nombre"), "left")
        .withColumn(out, F.coalesce("iso_codigo", F.lit(fixed.UNKNOWN_ISO)))
        .drop("iso_nombre", "iso_codigo")
    )


def bucket_name(column_name: Column) -> Column:
    """Term bucket inside a person-type column name; unchanged when there is none."""
    dash = F.instr(column_name, " - ")
    found = F.regexp_extract(column_name, fixed.BUCKET_PATTERN, 1)
    return (
        F.when(dash > 0, strip(F.substring(column_name, dash + 3, F.length(column_name))))
        .when(found != "", strip(found))
        .otherwise(column_name)
    )


def key_text(df: DataFrame, name: str) -> Column:
    """Comparable form of a key: dates are read day-first or as ISO, blank equals NULL."""
    kind = dict(df.dtypes)[name]
    value = F.col(name)
    if name.lower() == "fecha":
        day = calendar.parse_day(value) if kind == "string" else value.cast("date")
        return day.cast("string")
    return F.nullif(value.cast("string"), F.lit(""))
