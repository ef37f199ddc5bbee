"""Streaming queries: the tables are read as file streams and run to completion."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import gates
from tidemark.operators import merge
from tidemark.plans.gate_queries import LABEL_SQL, labels
from tidemark.plans.registry import query, table
from tidemark.plans.web_queries import IDLE_GAP, PAGE_COMPLETE_SQL, SESSIONS_SQL
from tidemark.session import even_out, scratch_path
from tidemark.sources import accumulated
from tidemark.streaming import captures, quarantine
from tidemark.streaming import events as streams


def stream_of(spark, sf_dir, name):
    schema = table(spark, sf_dir, name).schema
    return streams.read_stream(spark, sf_dir, schema, f"{name}.parquet")


@query(
    "idle_sessions_stream",
    f"""
    SELECT * FROM ({SESSIONS_SQL}) s
    WHERE fin <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)
    """,
)
def idle_sessions_stream(spark, sf_dir):
    """As the batch query, but the sessions still open at the end are not shown."""
    sessions = streams.idle_sessions(
        stream_of(spark, sf_dir, "events").select("user_id", "ts"), "user_id", gap="2 hours", late="1 hour"
    )
    closed = spark.read.parquet(streams.run_to_files(sessions, "idle-sessions"))
    # Back to times without zone, as the events have them.
    return closed.select(
        "user_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("inicio", "fin")], "eventos"
    )


@query(
    "first_per_url_stream",
    """
    SELECT user_id, 'https://site.example.com/' || regexp_extract(props, '\\d+') AS url,
      min(ts) AS ts, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2
    """,
)
def first_per_url_stream(spark, sf_dir):
    """First event of every URL of a capture (here: a user)."""
    url = F.concat(F.lit("https://site.example.com/"), F.regexp_extract("props", r"\d+", 0))
    keys = ["user_id", "url"]
    seen = streams.first_per_url(
        stream_of(spark, sf_dir, "events").select("user_id", url.alias("url"), "ts", "event_id"), keys
    )
    return streams.settled_first(spark.read.parquet(streams.run_updates(seen, "first-per-url")), keys)


UPSERT_KEYS = ["fecha", "tipo_moneda", "banco"]


@query(
    "upsert_stream",
    """
    SELECT o_orderdate::date AS fecha, o_orderstatus AS tipo_moneda, o_orderpriority AS banco,
      arg_max(o_totalprice, o_orderkey) AS valor FROM orders GROUP BY 1, 2, 3
    """,
)
def upsert_stream(spark, sf_dir):
    """Orders as arriving rates: the last arrival per date, currency and bank remains, though newer ones come first."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("fecha"), F.col("o_orderstatus").alias("tipo_moneda"),
        F.col("o_orderpriority").alias("banco"), F.col("o_totalprice").alias("valor"),
        F.col("o_orderkey").alias("llegada"),
    )
    folder = scratch_path(spark, "rates")
    for odd in (1, 0):
        orders.filter(F.col("llegada") % 2 == odd).coalesce(1).write.mode("append").parquet(folder)
    arriving = streams.read_stream(spark, folder, orders.schema, files_per_batch=1)
    path = scratch_path(spark, "accumulated")
    streams.upsert_stream(
        arriving, path, UPSERT_KEYS, "llegada", scratch_path(spark, "accumulated-state")
    ).awaitTermination()
    return accumulated.read_accumulated(spark, path).drop("llegada")


@query(
    "gated_ingest_stream",
    f"WITH {LABEL_SQL} SELECT o_orderkey, pedida, eff AS vigente_al FROM dated "
    "WHERE eff IS NULL OR eff = strftime(pedida, '%d/%m/%Y')",
)
def gated_ingest_stream(spark, sf_dir):
    """Captures arriving as a stream, those in force for another date left out."""
    arriving = labels(spark, sf_dir, stream_of(spark, sf_dir, "orders"))
    kept = streams.in_force_captures(
        arriving.withColumnsRenamed({"pedida": "requested_date", "etiqueta": "label_text"})
    )
    out = kept.select(
        "o_orderkey", F.col("requested_date").alias("pedida"),
        gates.effective_date(F.col("label_text")).alias("vigente_al"),
    )
    return spark.read.parquet(streams.run_to_files(out, "gated-ingest"))


@query("accumulated_batches", """
    SELECT o_orderdate::date AS fecha, o_orderstatus AS tipo_moneda, o_orderpriority AS banco,
      arg_max(o_totalprice, o_orderkey) AS valor FROM orders GROUP BY 1, 2, 3
    """)
def accumulated_batches(spark, sf_dir):
    """Two batches merged into the month-partitioned table, the second replacing rows."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("fecha"), F.col("o_orderstatus").alias("tipo_moneda"),
        F.col("o_orderpriority").alias("banco"), F.col("o_totalprice").alias("valor"),
        F.col("o_orderkey").alias("llegada"),
    )
    latest = merge.latest_per_key(rows, UPSERT_KEYS, "llegada").drop("llegada")
    path = scratch_path(spark, "batches")
    accumulated.write_accumulated(latest.withColumn("valor", -F.col("valor")), path, UPSERT_KEYS)
    accumulated.write_accumulated(latest, path, UPSERT_KEYS)
    return accumulated.read_accumulated(spark, path)


def in_drops(spark, rows, folder, day="ts", days=8, drops=4, late=7):
    """Write rows as files that come one drop after the other: by ``days`` of time, every ``late``-th row a drop later.

    A last row without key, far ahead, moves the watermark past everything. A drop is as many files as one batch takes,
    so the number of batches, each of which goes through the state of its captures, does not grow with the rows.
    """
    first = rows.agg(F.min(day).alias("desde"))
    number = F.floor(F.timestamp_diff("HOUR", "desde", day) / (24 * days)).cast("int")
    order = F.least(number + (F.col("event_id") % late == 0).cast("int"), F.lit(drops - 1))
    dealt = rows.crossJoin(F.broadcast(first)).withColumn("_n", order).drop("desde")
    for n in range(drops):
        even_out(dealt.filter(F.col("_n") == n).drop("_n")).write.mode("append").parquet(folder)
    kept = [F.lit(None).cast(kind).alias(c) for c, kind in rows.dtypes if c != day]
    ahead = rows.agg((F.max(day) + F.expr("INTERVAL 400 DAYS")).alias(day)).select(day, *kept).select(*rows.columns)
    ahead.write.mode("append").parquet(folder)
    return streams.read_stream(spark, folder, rows.schema, files_per_batch=int(spark.conf.get("spark.sql.shuffle.partitions")))


def settled(spark, stream, label):
    out = scratch_path(spark, label)
    captures.append_files(stream, out, scratch_path(spark, f"{label}-state")).awaitTermination()
    return spark.read.parquet(out)


def as_log_time(*columns):
    """Back to times without zone, as the events have them."""
    return [F.col(c).cast("timestamp_ntz").alias(c) for c in columns]


@query("network_idle_stream", PAGE_COMPLETE_SQL)
def network_idle_stream(spark, sf_dir):
    """The quiet moment of every capture, from files that come late and out of order."""
    kind = F.col("event_type")
    method = F.when(kind == "signup", "Page.loadEventFired").otherwise(F.concat(F.lit("Network."), kind))
    events = table(spark, sf_dir, "events").select("user_id", "ts", method.alias("method"), "event_id")
    arriving = in_drops(spark, events, scratch_path(spark, "log-files"))
    found = captures.network_idle(
        arriving, "user_id", gap_seconds=IDLE_GAP, cap_seconds=720 * IDLE_GAP,
        complete=F.col("method") == "Page.loadEventFired", late="9 days", forget_seconds=400 * 86400,
    )
    return settled(spark, found, "quiet").select("user_id", *as_log_time("inicio", "reposo"), "por_tope")


@query(
    "first_per_url_visit_stream",
    """
    WITH e AS (SELECT user_id, 'https://site.example.com/' || regexp_extract(props, '\\d+') AS url, ts, event_id FROM events),
    g AS (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 24 HOUR, true) AS abre FROM e),
    v AS (SELECT *, sum(abre::INTEGER) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM g)
    SELECT user_id, url, min(ts) AS ts, arg_min(event_id, (ts, event_id::VARCHAR)) AS event_id FROM v GROUP BY user_id, n, url
    """,
)
def first_per_url_visit_stream(spark, sf_dir):
    """First event of every URL of a visit; a user's state is cleared after a day without events."""
    url = F.concat(F.lit("https://site.example.com/"), F.regexp_extract("props", r"\d+", 0))
    events = table(spark, sf_dir, "events").select("user_id", url.alias("url"), "ts", "event_id")
    arriving = in_drops(spark, events, scratch_path(spark, "url-files"))
    found = captures.first_per_url(arriving, "user_id", idle_seconds=86400, late="9 days")
    return settled(spark, found, "visits").select("user_id", "url", *as_log_time("ts"), "event_id")


LATE_CUT = "1996-01-01"


@query(
    "quarantined_ingest_stream",
    f"""
    WITH {LABEL_SQL}, limits AS (SELECT max(pedida) - 365 AS l FROM dated WHERE pedida >= DATE '{LATE_CUT}'),
    rows AS (SELECT CASE WHEN eff IS NOT NULL AND eff <> strftime(pedida, '%d/%m/%Y') THEN 'no vigente'
      WHEN pedida < DATE '{LATE_CUT}' AND pedida < l THEN 'tarde' ELSE 'aceptada' END AS motivo, o_orderkey FROM dated, limits)
    SELECT motivo, count(*) AS filas, sum(o_orderkey)::BIGINT AS claves FROM rows GROUP BY 1
    UNION ALL SELECT 'leidas', count(*), NULL FROM rows
    """,
)
def quarantined_ingest_stream(spark, sf_dir):
    """Captures in two drops, the old dates last: each is accepted, in force for another date or late; none is lost."""
    rows = labels(spark, sf_dir).withColumnsRenamed({"pedida": "requested_date", "etiqueta": "label_text"})
    folder, out = scratch_path(spark, "labels"), scratch_path(spark, "checked")
    stale = F.when(~gates.in_force(F.col("label_text"), F.col("requested_date")), "no vigente")
    state = scratch_path(spark, "checked-state")
    # A drop is as many files as it has tasks, and one batch, since each is taken up before the next one comes.
    for new in (True, False):
        rows.filter((F.col("requested_date") >= LATE_CUT) == new).write.mode("append").parquet(folder)
        quarantine.ingest_checked(
            streams.read_stream(spark, folder, rows.schema), out, state, stale, ts="requested_date", late_seconds=365 * 86400,
        ).awaitTermination()
    by_reason = quarantine.rows(spark, out, rows.schema).groupBy("motivo").agg(
        F.count(F.lit(1)).alias("filas"), F.sum("o_orderkey").alias("claves")
    )
    read = quarantine.counts(spark, out).agg(F.sum("leidas").alias("filas"))
    return by_reason.unionByName(read.select(F.lit("leidas").alias("motivo"), "filas", F.lit(None).cast("bigint").alias("claves")))
