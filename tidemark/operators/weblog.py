"""Request records, redirects, failures, resources and idle points of a capture.

A record is kept flat: one row per request with its last request, response and loading,
and its redirects and failures as rows of their own. No list of events is ever gathered
into one row, so a request with very many hops is just many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import fixed, urls

KEYS = ["capture_id", "request_id"]
REQUEST = "Network.requestWillBeSent"
RESPONSE = "Network.responseReceived"
FINISHED = "Network.loadingFinished"
FAILED = "Network.loadingFailed"


def request_events(events: DataFrame) -> DataFrame:
    """The four kinds of event that count, with a request id."""
    request_id = F.nullif(F.col("params.requestId"), F.lit(""))
    return (
        events.filter(F.col("method").isin(REQUEST, RESPONSE, FINISHED, FAILED))
        .withColumn("request_id", request_id)
        .filter(F.col("request_id").isNotNull())
    )


def _normal(url: Column) -> Column:
    return urls.normalise_url(F.coalesce(url, F.lit("")))


def request_records(events: DataFrame) -> DataFrame:
    """One row per request: the last request, response and loading, and how much else.

    Every measure is a map-side-combined aggregate; a request that holds most of the log
    shuffles one row per task.
    """
    p = "params."
    request = F.struct(
        _normal(F.col(p + "request.url")).alias("url"),
        F.col(p + "request.method").alias("method"),
        F.col(p + "request.headers").alias("headers"),
        F.col(p + "request.postData").alias("post_data"),
        F.col(p + "initialPriority").alias("initial_priority"),
        F.col(p + "type").alias("resource_type"),
        F.col(p + "documentURL").alias("document_url"),
        F.col(p + "timestamp").alias("timestamp"),
        F.col(p + "wallTime").alias("wall_time"),
        F.col(p + "initiator").alias("initiator"),
    )
    response = F.struct(
        _normal(F.col(p + "response.url")).alias("url"),
        F.col(p + "response.status").alias("status"),
        F.col(p + "response.statusText").alias("status_text"),
        F.col(p + "response.mimeType").alias("mime_type"),
        F.col(p + "response.headers").alias("headers"),
        F.col(p + "response.protocol").alias("protocol"),
        F.col(p + "response.remoteIPAddress").alias("remote_ip"),
        F.col(p + "response.fromDiskCache").alias("from_disk_cache"),
        F.col(p + "response.fromServiceWorker").alias("from_service_worker"),
        F.col(p + "type").alias("resource_type"),
        F.col(p + "timestamp").alias("timestamp"),
    )
    loading = F.struct(
        F.lit(True).alias("finished"),
        F.col(p + "encodedDataLength").alias("encoded_data_length"),
        F.col(p + "timestamp").alias("timestamp"),
    )

    def last(value: Column, method: str) -> Column:
        return F.max_by(value, F.when(F.col("method") == method, F.col("seq")))

    hop = (F.col("method") == REQUEST) & F.col("params.redirectResponse").isNotNull()
    return (
        request_events(events)
        .groupBy(*KEYS)
        .agg(
            F.min("seq").alias("first_seq"),
            last(request, REQUEST).alias("request"),
            last(response, RESPONSE).alias("response"),
            last(loading, FINISHED).alias("loading"),
            F.count(F.when(hop, 1)).alias("n_redirects"),
            F.count(F.when(F.col("method") == FAILED, 1)).alias("n_failures"),
        )
    )


def redirects(events: DataFrame) -> DataFrame:
    """One row per redirect hop; ``seq`` orders the hops of a request."""
    hop = F.col("params.redirectResponse")
    return (
        request_events(events)
        .filter((F.col("method") == REQUEST) & hop.isNotNull())
        .select(
            *KEYS, "seq", hop["status"].alias("status"), _normal(hop["url"]).alias("url"),
            hop["headers"].alias("headers"), hop["mimeType"].alias("mime_type"),
        )
    )


def failures(events: DataFrame) -> DataFrame:
    """One row per failure, ordered by ``seq``."""
    return (
        request_events(events)
        .filter(F.col("method") == FAILED)
        .select(
            *KEYS, "seq",
            F.col("params.errorText").alias("error_text"),
            F.col("params.canceled").alias("canceled"),
            F.col("params.blockedReason").alias("blocked_reason"),
            F.col("params.timestamp").alias("timestamp"),
        )
    )


def numbered(rows: DataFrame, keys: list[str], order: str, out: str, slice_rows: int = 65536) -> DataFrame:
    """Number the rows of each key from 0 in the order of a unique integer column.

    A key is cut into slices of at most ``slice_rows`` consecutive order values. Slices are
    numbered on their own and shifted by the sizes of the slices before, so no task has to
    sort all rows of one key.
    """
    sliced = rows.withColumn("_tramo", F.floor(F.col(order) / F.lit(slice_rows)))
    before = Window.partitionBy(*keys).orderBy("_tramo").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        sliced.groupBy(*keys, "_tramo").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_antes", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    within = Window.partitionBy(*keys, "_tramo").orderBy(order)
    return (
        sliced.withColumn("_en", F.row_number().over(within) - 1)
        .join(sizes, [*keys, "_tramo"])
        .withColumn(out, F.col("_antes") + F.col("_en"))
        .drop("_tramo", "_antes", "_en")
    )


def redirect_hops(events: DataFrame) -> DataFrame:
    """Redirects with their place in the chain."""
    return numbered(redirects(events), KEYS, "seq", "hop")


def body_bytes(bodies: DataFrame) -> DataFrame:
    """``capture_id, request_id, bytes``: decoded length, worked out before any join."""
    decoded = F.try_to_binary("body", F.lit("base64"))
    size = F.when(F.col("base64_encoded"), F.octet_length(decoded)).otherwise(
        F.octet_length(F.encode("body", "UTF-8"))
    )
    return bodies.select(*KEYS, size.alias("bytes"))


def resources(records: DataFrame, bodies: DataFrame) -> DataFrame:
    """First record per URL of a capture, with its body size; ``bytes`` NULL without body.

    A URL whose first record has no body is not retried with a later record. The first one
    is found by an aggregate over ``first_seq``, not by ranking all records of a URL.
    """
    own = F.nullif(F.col("response.url"), F.lit(""))
    url = F.coalesce(own, F.nullif(F.col("request.url"), F.lit("")))
    picked = F.min_by(
        F.struct(
            "request_id",
            F.col("response.status").alias("status"),
            F.col("response.mime_type").alias("mime_type"),
            F.col("response.from_service_worker").alias("from_service_worker"),
            F.col("response.from_disk_cache").alias("from_disk_cache"),
        ),
        "first_seq",
    )
    first = (
        records.withColumn("url", url)
        .filter(F.col("url").startswith("http://") | F.col("url").startswith("https://"))
        .groupBy("capture_id", "url")
        .agg(picked.alias("r"), F.min("first_seq").alias("first_seq"))
        .select("capture_id", "url", "first_seq", "r.*")
    )
    relpath = urls.safe_relpath(F.col("url"), F.col("mime_type"))
    return (
        first.join(body_bytes(bodies), KEYS, "left")
        .withColumn("relpath", relpath)
        .withColumn("local_ref", F.concat(F.lit("/"), "relpath"))
    )


def saved(found: DataFrame) -> DataFrame:
    return found.filter(F.col("bytes").isNotNull())


def url_map(found: DataFrame) -> DataFrame:
    """``capture_id, url, local`` of everything saved."""
    return saved(found).select("capture_id", "url", F.col("local_ref").alias("local"))


def body_warnings(found: DataFrame) -> DataFrame:
    return found.filter(F.col("bytes").isNull()).select(
        "capture_id",
        F.lit("get_response_body").alias("stage"),
        F.lit("No body captured").alias("message"),
        "url",
        "request_id",
    )


def missing_css_warnings(missing: DataFrame) -> DataFrame:
    """Warnings for style-sheet references that were not saved (``capture_id, url``)."""
    return missing.select(
        "capture_id",
        F.lit("rewrite_css_missing").alias("stage"),
        F.lit("No local mapping found").alias("message"),
        "url",
        F.lit(None).cast("string").alias("request_id"),
    )


def rewrite_warnings(rewritten: DataFrame, errors: str = "error", stage: str = "rewrite_css") -> DataFrame:
    """Warnings for documents that could not be rewritten (``capture_id, url`` and the column of errors)."""
    return rewritten.filter(F.col(errors).isNotNull()).select(
        "capture_id", F.lit(stage).alias("stage"), F.col(errors).alias("message"), "url",
        F.lit(None).cast("string").alias("request_id"),
    )


def capture_summary(found: DataFrame, warnings: DataFrame, missing: DataFrame) -> DataFrame:
    """Saved, missing and warning counts per capture.

    The three are counted in one aggregate over their union: nothing is joined.
    """
    parts = (
        saved(found).select("capture_id", F.lit("saved").alias("que"))
        .unionByName(warnings.select("capture_id", F.lit("warning").alias("que")))
        .unionByName(missing.select("capture_id", F.lit("missing").alias("que")))
    )

    def count_of(kind: str, out: str) -> Column:
        return F.count(F.when(F.col("que") == kind, 1)).alias(out)

    return parts.groupBy("capture_id").agg(
        count_of("saved", "saved_count"),
        count_of("missing", "missing_refs_count"),
        count_of("warning", "warnings_count"),
    )


def _first_host(kept: DataFrame) -> DataFrame:
    return kept.groupBy("capture_id").agg(
        F.min_by(F.substring_index("relpath", "/", 1), "first_seq").alias("host")
    )


def manifest(found: DataFrame, warnings: DataFrame, missing: DataFrame, opened: DataFrame) -> DataFrame:
    """The summary of each capture with its addresses and the paths of its two final pages.

    ``opened`` has one row per capture: ``capture_id, root_url, final_url``. A capture that
    saved nothing has no paths.
    """
    return (
        capture_summary(found, warnings, missing)
        .join(opened.select("capture_id", "root_url", "final_url"), "capture_id", "left")
        .join(_first_host(saved(found)), "capture_id", "left")
        .withColumn("final_html", F.concat("host", F.lit("/index.final.html")))
        .withColumn("offline_html", F.concat("host", F.lit("/index.offline.html")))
        .drop("host")
    )


def tree(found: DataFrame) -> DataFrame:
    """Saved paths of each capture and its two final pages, sorted.

    ``main_host`` is the host of the first resource of the capture.
    """
    kept = saved(found)
    pages = _first_host(kept).select(
        "capture_id",
        F.explode(
            F.array(
                F.concat("host", F.lit("/index.final.html")),
                F.concat("host", F.lit("/index.offline.html")),
            )
        ).alias("relpath"),
    )
    return kept.select("capture_id", "relpath").unionByName(pages).orderBy("capture_id", "relpath")


def _micros(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    epoch = F.lit("1970-01-01 00:00:00").cast(kind)
    return F.timestamp_diff("MICROSECOND", epoch, F.col(column))


def _time_bins(events: DataFrame, key: str, ts: str, gap_seconds: float) -> DataFrame:
    """First and last event per key and time bin as wide as the gap.

    Two events of one bin are always less than a gap apart, so gaps can only lie between
    bins. What is left per key is bounded by its time span, not by its number of events.
    """
    micros = _micros(events, ts)
    width = int(gap_seconds * 1_000_000)
    return events.groupBy(key, F.floor(micros / F.lit(width)).alias("bin")).agg(
        F.min(micros).alias("desde"), F.max(micros).alias("hasta"), F.count(F.lit(1)).alias("eventos")
    )


def network_idle(
    events: DataFrame,
    key: str = "capture_id",
    ts: str = "ts",
    gap_seconds: float = fixed.IDLE_GAP_SECONDS,
    cap_seconds: float = fixed.IDLE_CAP_SECONDS,
    complete: Column | None = None,
) -> DataFrame:
    """When each capture went quiet: the first gap of at least ``gap_seconds``, capped.

    ``inicio`` is the first event; ``reposo`` the end of the gap's waiting time, or the
    start plus ``cap_seconds`` when that comes first (``por_tope``). Where events name their
    ``method``, only those of the network domain count. ``complete`` says which events report
    the page complete: before the first of them no gap ends, and without one the cap decides.
    """
    seen = events
    if "method" in events.columns:
        events = events.filter(F.col("method").startswith("Network."))
    gap, cap = int(gap_seconds * 1_000_000), int(cap_seconds * 1_000_000)
    by_time = Window.partitionBy(key).orderBy("bin")
    bins = _time_bins(events, key, ts, gap_seconds).withColumn(
        "siguiente", F.lead("desde").over(by_time)
    )
    rest = F.col("hasta") + gap
    quiet = F.col("siguiente").isNull()
    if complete is not None:
        ready = seen.filter(complete).groupBy(key).agg(F.min(_micros(seen, ts)).alias("completa"))
        bins = bins.join(ready, key, "left")
        rest = F.when(F.col("completa").isNotNull(), F.greatest(rest, "completa"))
    found = bins.groupBy(key).agg(
        F.min("desde").alias("inicio"), F.min(F.when(quiet | (F.col("siguiente") >= rest), rest)).alias("quieto")
    )
    epoch = F.lit("1970-01-01 00:00:00").cast(dict(events.dtypes)[ts])

    def moment(micros: Column) -> Column:
        return F.timestamp_add("MICROSECOND", micros, epoch)

    return found.select(
        key,
        moment(F.col("inicio")).alias("inicio"),
        moment(F.least("quieto", F.col("inicio") + cap)).alias("reposo"),
        F.coalesce(F.col("quieto") > F.col("inicio") + cap, F.lit(True)).alias("por_tope"),
    )


def idle_sessions(
    events: DataFrame, key: str = "capture_id", ts: str = "ts", gap_seconds: float = fixed.IDLE_GAP_SECONDS
) -> DataFrame:
    """Runs of events less than a gap apart: ``inicio``, ``fin`` (last event plus gap), count."""
    gap = int(gap_seconds * 1_000_000)
    by_time = Window.partitionBy(key).orderBy("bin")
    bins = _time_bins(events, key, ts, gap_seconds)
    starts = F.coalesce(F.col("desde") - F.lag("hasta").over(by_time) >= gap, F.lit(True))
    marked = bins.withColumn("_abre", starts.cast("int"))
    numbered_bins = marked.withColumn(
        "_sesion", F.sum("_abre").over(by_time.rowsBetween(Window.unboundedPreceding, 0))
    )
    epoch = F.lit("1970-01-01 00:00:00").cast(dict(events.dtypes)[ts])
    return (
        numbered_bins.groupBy(key, "_sesion")
        .agg(F.min("desde").alias("a"), F.max("hasta").alias("b"), F.sum("eventos").alias("eventos"))
        .select(
            key,
            F.timestamp_add("MICROSECOND", F.col("a"), epoch).alias("inicio"),
            F.timestamp_add("MICROSECOND", F.col("b") + gap, epoch).alias("fin"),
            "eventos",
        )
    )
