"""Streams of captures with event-time timers: the moment each went quiet, and the first event per URL.

Both keep one small state per capture and forget it once the watermark says that the capture is over, so the state
is bounded by the captures that are open, not by all that were ever seen. Events are folded in every input task
before they are shuffled: runs of events closer than the gap become one row, whatever share of the events a
capture has. The result does not depend on how events are cut into batches or in which order they come, as long
as none is later than the watermark allows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import fixed
from tidemark.streaming.events import event_time
from tidemark.streaming.timers import FirstPerUrl, IdlePoint

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_timers(spark) -> None:
    """State with timers needs this store; a running query keeps the one it was started with."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts))


def _moment(micros: str) -> Column:
    return F.timestamp_micros(F.col(micros))


def network_idle(
    stream: DataFrame,
    key: str = "capture_id",
    ts: str = "ts",
    gap_seconds: float = fixed.IDLE_GAP_SECONDS,
    cap_seconds: float = fixed.IDLE_CAP_SECONDS,
    complete: Column | None = None,
    late: str = "1 minute",
    forget_seconds: float = 3600,
) -> DataFrame:
    """When each capture went quiet, as ``weblog.network_idle`` says it, for output mode ``append``.

    A capture shows once the watermark has passed its quiet moment. It is then remembered for ``forget_seconds`` after
    its last event, so that further events are known to be its own and change nothing; an event after that opens
    the capture anew, and a second row. Rows with a NULL key only move the watermark.
    """
    gap = int(gap_seconds * 1_000_000)
    events = event_time(stream, ts).withWatermark(ts, late)
    reported = F.lit(False) if complete is None else F.coalesce(complete, F.lit(False))
    network = F.col("method").startswith("Network.") if "method" in stream.columns else F.lit(True)
    slim = events.where(F.coalesce(network, F.lit(False)) | reported | F.col(key).isNull()).select(
        F.col(key).alias("clave"), _micros(ts).alias("desde"), reported.alias("completa"),
        F.coalesce(network, F.lit(False)).alias("de_red"),
    )
    # A complete page may be reported by an event that counts as traffic too.
    parts = F.filter(
        F.array(F.struct(F.lit(True).alias("completa"), F.col("completa").alias("vale")),
                F.struct(F.lit(False).alias("completa"), F.col("de_red").alias("vale"))),
        lambda p: p["vale"],
    )
    slim = slim.select("clave", "desde", F.explode(parts).alias("p")).select("clave", "desde", "p.completa")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            bins = rows.groupby(["clave", rows.desde // gap, "completa"], dropna=False).desde
            yield pd.DataFrame({"desde": bins.min(), "hasta": bins.max()}).rename_axis(["clave", "tramo", "completa"]).reset_index()[
                ["clave", "desde", "hasta", "completa"]
            ]

    kind = dict(stream.dtypes)[key]
    folded = slim.mapInPandas(fold, f"clave {kind}, desde bigint, hasta bigint, completa boolean")
    use_timers(stream.sparkSession)
    found = folded.groupBy("clave").transformWithState(
        IdlePoint(gap, int(cap_seconds * 1_000_000), int(forget_seconds * 1_000_000), complete is not None),
        f"clave {kind}, inicio bigint, reposo bigint, por_tope boolean", "append", "eventTime",
    )
    return found.select(F.col("clave").alias(key), _moment("inicio").alias("inicio"), _moment("reposo").alias("reposo"), "por_tope")


def first_per_url(
    stream: DataFrame, key: str = "capture_id", url: str = "url", ts: str = "ts",
    idle_seconds: float = fixed.IDLE_CAP_SECONDS, late: str = "1 minute",
) -> DataFrame:
    """The first event by time of every URL of a capture, for output mode ``append``.

    A capture is over when the watermark is ``idle_seconds`` past its last event. Its rows show then, and all that was
    known of it is cleared; events that come after begin the capture anew. Of events at one time the one with the
    least remaining columns (as JSON) is first. A NULL URL is one of its own; rows with a NULL key only move the watermark.
    """
    idle = int(idle_seconds * 1_000_000)
    rest = [c for c in stream.columns if c not in (key, url, ts)]
    events = event_time(stream, ts).withWatermark(ts, late).select(
        F.col(key).alias("clave"), F.col(url).cast("string").alias("url"), _micros(ts).alias("desde"),
        (F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}) if rest else F.lit("{}")).alias("fila"),
    ).where("desde IS NOT NULL")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows = rows.sort_values(["desde", "fila"], kind="stable")
            bins = rows.groupby(["clave", "url", rows.desde // idle], dropna=False, sort=False)
            made = bins.agg(desde_=("desde", "first"), hasta=("desde", "last"), fila=("fila", "first"))
            made = made.rename_axis(["clave", "url", "tramo"]).reset_index()
            made["url"] = made.url.astype(object).where(made.url.notna(), None)
            yield made.rename(columns={"desde_": "desde"})[["clave", "url", "desde", "hasta", "fila"]]

    kind = dict(stream.dtypes)[key]
    folded = events.mapInPandas(fold, f"clave {kind}, url string, desde bigint, hasta bigint, fila string")
    use_timers(stream.sparkSession)
    found = folded.groupBy("clave").transformWithState(
        FirstPerUrl(idle), f"clave {kind}, url string, desde bigint, fila string", "append", "eventTime"
    )
    types = dict(stream.dtypes)
    if not rest:
        return found.select(F.col("clave").alias(key), F.col("url").alias(url), _moment("desde").alias(ts))
    parsed = F.from_json("fila", ", ".join(f"`{c}` {types[c]}" for c in rest)).alias("f")
    return found.select(F.col("clave").alias(key), F.col("url").alias(url), _moment("desde").alias(ts), parsed).select(
        key, url, ts, *[F.col(f"f.`{c}`").alias(c) for c in rest]
    )


def append_files(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append what is settled to Parquet files at ``out``, over all input there is; started again it goes on from there."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
