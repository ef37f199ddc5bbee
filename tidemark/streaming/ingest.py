"""Files of captured pages arriving as a stream: gates, extraction, ledger and accumulated table, each once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.operators import merge
from tidemark.session import materialise
from tidemark.sources import accumulated, capture_files


@dataclass(frozen=True)
class Store:
    """Where an ingest keeps what it has: the pages by batch, the dates' facts by batch, and the rates."""

    root: str

    @property
    def pages(self) -> str:
        return f"{self.root}/paginas"

    @property
    def facts(self) -> str:
        return f"{self.root}/hechos"

    @property
    def rates(self) -> str:
        return f"{self.root}/tasas"


def page_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format("binaryFile").schema(capture_files.FILE_SCHEMA).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def noticed_stream(spark: SparkSession, notices: str) -> DataFrame:
    """The files that ``capture_files.write_files`` has left notices of, read inside tasks.

    The source follows a few lists, so what the driver keeps does not grow with the number of pages.
    """
    return capture_files.with_content(spark.readStream.schema(capture_files.LISTING_SCHEMA).parquet(notices))


def pages_up_to(spark: SparkSession, store: Store, batch_id: int, years: list[int]) -> DataFrame:
    """Stored pages of some years, of a batch and those before it."""
    held = spark.read.parquet(store.pages)
    return held.filter((F.col("lote") <= batch_id) & F.col("anio").isin(years))


def ingest(stream: DataFrame, store: Store, checkpoint: str) -> StreamingQuery:
    """Process all files there are and stop; started again with the same checkpoint it takes up the new ones.

    A batch's pages are written under its number, over what a cut-off run may have left. Dates they touch are then
    put together again from all pages stored so far, so a foreign page may come in any batch before or after its national
    one. Rates go into the accumulated table by version, and the table's list names the batch, so each file counts once.

    Rates of a bank that a date's newer page no longer has stay in the table, as in any upsert.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        pages = capture_files.pages_of(batch).filter(F.col("requested_date").isNotNull())
        place = f"{store.pages}/lote={batch_id}"
        # Rows of a year meet before they are written, so a year is a few files and not one for every task.
        (
            pages.withColumn("anio", F.year("requested_date")).hint("rebalance", F.col("anio"))
            .write.mode("overwrite").partitionBy("anio").parquet(place)
        )
        schema = StructType([*pages.schema.fields, StructField("anio", IntegerType())])
        new = spark.read.schema(schema).parquet(place).select("requested_date", "anio")
        # At most one entry per calendar year.
        years = [r[0] for r in new.select("anio").distinct().collect()]
        if not years:
            return
        touched = new.select("requested_date").distinct()
        own = pages_up_to(spark, store, batch_id, years).join(touched, "requested_date", "left_semi")
        rates = materialise(capture_files.general_rates(capture_files.assembled(own)), "rates")
        capture_files.page_facts(own, rates).write.mode("overwrite").parquet(f"{store.facts}/lote={batch_id}")
        accumulated.write_accumulated(rates, store.rates, merge.GENERAL_KEYS, "llegada", stream=checkpoint, batch_id=batch_id)

    return (
        stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def date_facts(spark: SparkSession, store: Store) -> DataFrame:
    """The facts of every date as its last batch left them."""
    last = F.max_by(F.struct("fallo", "vigente_al", "filas"), "lote").alias("_u")
    return spark.read.parquet(store.facts).groupBy("fecha").agg(last).select("fecha", "_u.fallo", "_u.vigente_al", "_u.filas")
