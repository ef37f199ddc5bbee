"""Streams that lose no row unseen: what is not accepted is kept with its reason, and everything is counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

ACCEPTED, LATE = "aceptada", "tarde"
COUNTS = "leidas bigint, aceptadas bigint, apartadas bigint, ultimo timestamp"


def counts(spark: SparkSession, out: str) -> DataFrame:
    """``lote, leidas, aceptadas, apartadas, ultimo`` of every batch."""
    return spark.read.schema(f"{COUNTS}, lote int").json(f"{out}/cuentas")


def rows(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """All rows read so far with their ``lote`` and ``motivo``; accepted ones have ``motivo`` ACCEPTED."""
    own = [StructField("lote", IntegerType()), StructField("motivo", StringType())]
    return spark.read.schema(StructType([*schema.fields, *own])).parquet(f"{out}/filas")


def ingest_checked(
    stream: DataFrame, out: str, checkpoint: str, reason: Column,
    ts: str | None = None, late_seconds: float | None = None,
) -> StreamingQuery:
    """Process all input there is; ``reason`` says why a row is set aside, NULL for a good one.

    With ``ts`` a good row is late, and set aside, if it is more than ``late_seconds`` before the latest time of the
    batches before its own; a NULL time never is. One pass writes a batch's rows by reason and counts them on the way,
    so accepted and set aside rows together are those read. A batch that is run again replaces what it wrote.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        why = reason
        if ts is not None and late_seconds is not None and batch_id:
            last = counts(spark, out).filter(F.col("lote") < batch_id).agg(F.max("ultimo")).first()[0]
            if last is not None:
                age = F.timestamp_diff("MICROSECOND", F.col(ts).cast("timestamp"), F.lit(last))
                why = F.coalesce(why, F.when(age > late_seconds * 1_000_000, LATE))
        latest = F.max(F.col(ts).cast("timestamp")) if ts is not None else F.lit(None).cast("timestamp")
        seen = Observation(f"lote-{batch_id}")
        good = F.col("motivo") == ACCEPTED
        marked = batch.withColumn("motivo", F.coalesce(why, F.lit(ACCEPTED))).observe(
            seen, F.count(F.lit(1)).alias("leidas"), F.count_if(good).alias("aceptadas"), F.count_if(~good).alias("apartadas"),
            *([latest.alias("ultimo")] if ts is not None else []),
        )
        marked.write.mode("overwrite").partitionBy("motivo").parquet(f"{out}/filas/lote={batch_id}")
        n = seen.get
        made = [(n["leidas"], n["aceptadas"], n["apartadas"], n.get("ultimo"))]
        spark.createDataFrame(made, COUNTS).coalesce(1).write.mode("overwrite").json(f"{out}/cuentas/lote={batch_id}")

    return (
        stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
