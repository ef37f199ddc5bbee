"""Streaming counterparts: idle sessions, first per URL, gated ingest, upsert per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions import gates
from tidemark.operators import merge
from tidemark.session import scratch_path
from tidemark.sources import accumulated


def read_stream(
    spark: SparkSession, folder: str, schema: StructType | str, name: str = "*",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files arriving in a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def event_time(stream: DataFrame, column: str = "ts") -> DataFrame:
    """Watermarks need a timestamp with time zone meaning."""
    return stream.withColumn(column, F.col(column).cast("timestamp"))


def idle_sessions(
    stream: DataFrame, key: str, ts: str = "ts", gap: str = "2 seconds", late: str = "1 minute"
) -> DataFrame:
    """Sessions closed by a gap. In append mode a session shows once the watermark is past it.

    With the setting of ``build_session`` sessions are merged inside each input task before
    the shuffle, so a key with very many events sends its sessions, not its events.
    """
    return (
        event_time(stream, ts)
        .withWatermark(ts, late)
        .groupBy(key, F.session_window(ts, gap).alias("s"))
        .agg(F.count(F.lit(1)).alias("eventos"))
        .select(key, F.col("s.start").alias("inicio"), F.col("s.end").alias("fin"), "eventos")
    )


def _earliest(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """The row with the least time per key; rows without one come last, ties by the rest."""
    rest = [c for c in df.columns if c not in (*keys, ts)]
    row = F.min(F.struct(F.col(ts).isNull().alias("_sin"), F.col(ts), *rest)).alias("_r")
    return df.groupBy(*keys).agg(row).select(
        *keys, *[F.col(f"_r.{c}").alias(c) for c in df.columns if c not in keys]
    )


def first_per_url(stream: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """First event per key by time, for output mode ``update``.

    An aggregate with one row of state per key: no key is forgotten, an earlier event that
    comes late replaces the first, and a hot key combines map-side.
    """
    return _earliest(stream, keys, ts)


def run_updates(stream: DataFrame, label: str) -> str:
    """Process all input there is and write each batch's changes to a folder of its own.

    A batch that is run again overwrites its own folder.
    """
    out = scratch_path(stream.sparkSession, label)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/lote={batch_id}")

    query = (
        stream.writeStream.foreachBatch(write).outputMode("update")
        .option("checkpointLocation", scratch_path(stream.sparkSession, f"{label}-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return out


def settled_first(updates: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """The last word of the updates: a first event only ever moves to an earlier time."""
    return _earliest(updates.drop("lote"), keys, ts)


def in_force_captures(stream: DataFrame) -> DataFrame:
    """Captures whose label does not contradict the requested date (a late page is skipped)."""
    return stream.filter(gates.in_force(F.col("label_text"), F.col("requested_date")))


def run_to_files(stream: DataFrame, label: str) -> str:
    """Process all input there is and write the output to Parquet; returns its path."""
    spark = stream.sparkSession
    out = scratch_path(spark, label)
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", out)
        .option("checkpointLocation", scratch_path(spark, f"{label}-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return out


def upsert_stream(
    stream: DataFrame, path: str, keys: list[str], arrival: str, checkpoint: str
) -> StreamingQuery:
    """Merge every micro-batch into the accumulated table, which keeps ``arrival``.

    Each key has its newest version: an older row that comes in a later batch loses. Within a batch the last arrival
    counts per key and, in long facts, per ``bucket`` and ``fila``. The table's list names the batch, so one that is run
    again after a failure is skipped.
    """

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        detail = [c for c in ("bucket", "fila") if c in batch.columns and c not in keys]
        latest = merge.latest_per_key(batch, [*keys, *detail], arrival)
        accumulated.write_accumulated(latest, path, keys, arrival, stream=checkpoint, batch_id=batch_id)

    return (
        stream.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
