"""The accumulated table: read, merge a batch in, publish; and plain exports.

A merge reads and rewrites the months its batch touches; all others stay as they are. Below
the table's path, ``datos`` holds one folder of months per merge and ``indice`` one numbered
list per merge, of the folder each month is read from. The list is written last: until it is
complete, readers see the table as it was, and nothing of that is ever overwritten. The list also
has the last batch of every stream that was merged, so that one which is run again is skipped.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.session import scratch_path

MONTH = "mes"


def _folder_names(spark: SparkSession, path: str) -> list[str]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(target)] if files.exists(target) else []


LIST_SCHEMA = "mes string, carpeta string, flujo string, lote bigint"


def _last_list(spark: SparkSession, path: str) -> list:
    """Rows of the last complete list: one per calendar month, and one per stream."""
    for number in sorted(map(int, _folder_names(spark, f"{path}/indice")), reverse=True):
        place = f"{path}/indice/{number}"
        if "_SUCCESS" in _folder_names(spark, place):
            return spark.read.schema(LIST_SCHEMA).json(place).collect()
    return []


def month_folders(spark: SparkSession, path: str) -> dict[str, str]:
    """Folder of every month by the last complete list; one entry per calendar month."""
    return {r.mes: r.carpeta for r in _last_list(spark, path) if r.mes is not None}


def merged_batches(spark: SparkSession, path: str) -> dict[str, int]:
    """The last batch of each stream that is in the table."""
    return {r.flujo: r.lote for r in _last_list(spark, path) if r.flujo is not None}


def _read(spark: SparkSession, path: str, months: dict[str, str]) -> DataFrame:
    places = [f"{path}/datos/{folder}/{MONTH}={month}" for month, folder in sorted(months.items())]
    # Months written before a column came up do not have it.
    return spark.read.option("mergeSchema", "true").parquet(*places)


def read_accumulated(spark: SparkSession, path: str) -> DataFrame | None:
    """The table so far; None when there is none yet."""
    months = month_folders(spark, path)
    return _read(spark, path, months) if months else None


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, F.coalesce(F.date_format("fecha", "yyyy-MM"), F.lit("sin-fecha")))


def _publish(spark: SparkSession, path: str, months: dict[str, str], batches: dict[str, int]) -> None:
    """Write the next list; fails if another merge has taken its number."""
    number = max(map(int, _folder_names(spark, f"{path}/indice")), default=0) + 1
    rows = [(m, f, None, None) for m, f in sorted(months.items())]
    rows += [(None, None, f, n) for f, n in sorted(batches.items())]
    spark.createDataFrame(rows, LIST_SCHEMA).coalesce(1).write.mode("error").json(f"{path}/indice/{number}")


def write_accumulated(
    batch: DataFrame, path: str, keys: list[str], arrival: str | None = None,
    stream: str | None = None, batch_id: int | None = None,
) -> str:
    """Merge a batch into the table at ``path``; gives ``no_rows``, ``written`` or ``skipped``.

    Merging the same batch again gives the same table, so a run that was cut off, at whatever
    point, is simply repeated. One merge at a time.

    With ``arrival`` the table keeps that column and each key its newest version (``merge.upsert_versions``):
    batches then give the same table in any order. Without it the batch replaces its keys. With ``stream`` and
    ``batch_id`` (ascending within a stream) the list names the batch, and one that is in the table already is skipped.
    """
    if "fecha" not in keys:
        raise ValueError("only the months of a batch are read: its keys must have fecha")
    spark = batch.sparkSession
    batches = merged_batches(spark, path)
    if stream is not None and batch_id is not None:
        if batch_id <= batches.get(stream, -1):
            return "skipped"
        batches = batches | {stream: batch_id}

    def merged_with(existing: DataFrame | None, new: DataFrame) -> DataFrame:
        if arrival is None:
            return merge.upsert(existing, new, keys)
        return merge.upsert_versions(existing, new, keys, arrival)

    incoming_path = scratch_path(spark, "batch")
    _with_month(merged_with(None, batch)).write.parquet(incoming_path)
    incoming = spark.read.parquet(incoming_path)
    # At most one entry per calendar month, whatever the size of the batch.
    touched = [r[0] for r in incoming.select(MONTH).distinct().collect()]
    months = month_folders(spark, path)
    if not touched:
        if stream is not None and months:
            _publish(spark, path, months, batches)
        return "no_rows"
    merged = incoming
    known = {m: months[m] for m in touched if m in months}
    if known:
        merged = _with_month(merged_with(_read(spark, path, known).drop(MONTH), incoming.drop(MONTH)))
    folder = uuid.uuid4().hex
    (
        # Even output files: small months are put together, a busy month is split.
        merged.hint("rebalance", F.col(MONTH))
        .sortWithinPartitions(MONTH, "fecha")
        .write.partitionBy(MONTH)
        .parquet(f"{path}/datos/{folder}")
    )
    _publish(spark, path, months | dict.fromkeys(touched, folder), batches)
    return "written"


def remove_old_versions(spark: SparkSession, path: str) -> None:
    """Delete folders the last list does not name; for when nobody reads an older one."""
    used = set(month_folders(spark, path).values())
    for folder in _folder_names(spark, f"{path}/datos"):
        if folder not in used:
            place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/datos/{folder}")
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def export_name(kind: str, start: date, end: date) -> str:
    """Fixed output names, the date range as ddmmyyyy."""
    first, last = f"{start:%d%m%Y}", f"{end:%d%m%Y}"
    return {
        "general": f"TPF_General_{first}-{last}",
        "person": f"TPF_Persona_{first}-{last}",
        "average": f"TipoCambio_{first}_{last}",
        "weighted": f"TipoCambioPonderado_{first}_{last}",
    }[kind]


def export_series(series: DataFrame, folder: str, kind: str, start: date, end: date, fmt: str = "parquet") -> str:
    """Write a series by year under its range name; returns the path."""
    path = f"{folder.rstrip('/')}/{export_name(kind, start, end)}"
    rows = series.withColumn("anio", F.year("fecha"))
    writer = rows.write.partitionBy("anio").mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per line, UTF-8, empty fields kept as null."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
