"""Captured network log: JSON messages to typed events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

LOG_SCHEMA = "capture_id bigint, seq bigint, ts timestamp, message string"
_RESPONSE = (
    "url:string,status:int,statusText:string,mimeType:string,headers:map<string,string>,"
    "protocol:string,remoteIPAddress:string,fromDiskCache:boolean,fromServiceWorker:boolean"
)
MESSAGE_SCHEMA = (
    "message struct<method:string,params:struct<requestId:string,"
    "request:struct<url:string,method:string,headers:map<string,string>,postData:string>,"
    f"redirectResponse:struct<{_RESPONSE}>,response:struct<{_RESPONSE}>,"
    "type:string,documentURL:string,initialPriority:string,timestamp:double,wallTime:double,"
    "initiator:string,encodedDataLength:double,errorText:string,canceled:boolean,"
    "blockedReason:string>>"
)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Log lines; one that is no JSON of this form has NULLs and its text in ``linea_mala``."""
    reader = spark.read.schema(f"{LOG_SCHEMA}, linea_mala string").option("columnNameOfCorruptRecord", "linea_mala")
    return reader.option("mode", "PERMISSIVE").json(path)


def parse_messages(log: DataFrame) -> DataFrame:
    """Add ``method`` and ``params``; entries that do not parse are left out."""
    message = F.from_json("message", MESSAGE_SCHEMA, {"mode": "PERMISSIVE"})["message"]
    others = [c for c in log.columns if c != "message"]
    # Filters on the fields stop at the generator, so no message is parsed a second time.
    return log.select(*others, F.inline(F.array(message))).filter(F.col("method").isNotNull())


def skipped_because(log: DataFrame, method: Column) -> Column:
    """Why an entry has no event; NULL where it has one."""
    bad_line = F.col("linea_mala").isNotNull() if "linea_mala" in log.columns else F.lit(False)
    return (
        F.when(bad_line, "line is no log entry")
        .when(F.col("message").isNull(), "no message")
        .when(method.isNull(), "message has no method")
    )


def split_log(log: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Events as ``parse_messages`` gives them, skipped entries with their ``motivo``, and the counts of both.

    One pass parses, writes both to the shared folder and counts ``leidas, eventos, omitidas`` on the way: what is read is
    either an event or a skipped entry.
    """
    parsed = F.from_json("message", MESSAGE_SCHEMA, {"mode": "PERMISSIVE"})["message"]
    marked = log.select("*", F.explode(F.array(F.struct(parsed.alias("m")))).alias("p")).withColumn(
        "motivo", skipped_because(log, F.col("p.m.method"))
    )
    seen = Observation()
    counted = marked.observe(
        seen, F.count(F.lit(1)).alias("leidas"), F.count_if(F.col("motivo").isNull()).alias("eventos"),
        F.count_if(F.col("motivo").isNotNull()).alias("omitidas"),
    )
    path = scratch_path(log.sparkSession, "log")
    counted.write.parquet(path)
    read = log.sparkSession.read.parquet(path)
    others = [c for c in log.columns if c not in ("message", "linea_mala")]
    events = read.filter("motivo IS NULL").select(*others, "p.m.*")
    return events, read.filter("motivo IS NOT NULL").select(*log.columns, "motivo"), seen.get
