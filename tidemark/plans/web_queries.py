"""Network-log and page-reference queries over events and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import refs, urls
from tidemark.operators import references, weblog
from tidemark.plans.registry import query, table
from tidemark.session import even_out, materialise, scratch_path
from tidemark.sources import network_log

# Events as a network log: view = request, click = response, purchase = finished,
# error = failed, signup = another method. A capture is a user, a request a user's day.
LOG_SQL = r"""
ev AS (SELECT user_id AS capture_id, event_id AS seq, ts, event_type, value,
    user_id || '-' || strftime(ts, '%Y%m%d') AS request_id,
    regexp_extract(props, '\d+')::INTEGER AS k FROM events),
log AS (SELECT *, CASE WHEN k % 20 = 9 THEN 'data:text/plain,' || k ELSE
      'https://site' || (k % 10) || '.example.com/p/' || k || CASE k % 4 WHEN 0 THEN '/' ELSE '' END
      || CASE WHEN k % 3 = 0 THEN '?q=' || k ELSE '' END END AS url,
    CASE k % 4 WHEN 0 THEN 'text/html; charset=utf-8' WHEN 1 THEN 'text/css'
      WHEN 2 THEN 'image/png' ELSE 'application/unknown' END AS mime
  FROM ev WHERE seq % 97 <> 0 AND seq % 53 <> 0 AND event_type <> 'signup'),
records AS (SELECT capture_id, request_id, min(seq) AS first_seq,
    arg_max_null(url, seq) FILTER (event_type = 'view') AS req_url,
    arg_max_null(CASE WHEN k % 20 = 7 THEN '' ELSE url END, seq) FILTER (event_type = 'click') AS resp_url,
    arg_max_null(200 + k, seq) FILTER (event_type = 'click') AS status,
    arg_max_null(mime, seq) FILTER (event_type = 'click') AS mime_type,
    arg_max_null(value, seq) FILTER (event_type = 'purchase') AS data_length,
    count(*) FILTER (event_type = 'view' AND k % 2 = 0) AS n_redirects,
    count(*) FILTER (event_type = 'error') AS n_failures
  FROM log GROUP BY ALL)
"""


def event_log(spark, sf_dir):
    """The events rendered as JSON messages, some broken and some without request id."""
    k = F.regexp_extract("props", r"\d+", 0).cast("int")
    kind = F.col("event_type")
    request_id = F.concat_ws("-", "user_id", F.date_format("ts", "yyyyMMdd"))
    url = F.when(k % 20 == 9, F.concat(F.lit("data:text/plain,"), k)).otherwise(
        F.concat(
            F.lit("https://site"), k % 10, F.lit(".example.com/p/"), k,
            F.when(k % 4 == 0, "/").otherwise(""),
            F.when(k % 3 == 0, F.concat(F.lit("?q="), k)).otherwise(""),
        )
    )
    mime = (
        F.when(k % 4 == 0, "text/html; charset=utf-8").when(k % 4 == 1, "text/css")
        .when(k % 4 == 2, "image/png").otherwise("application/unknown")
    )
    method = (
        F.when(kind == "view", weblog.REQUEST).when(kind == "click", weblog.RESPONSE)
        .when(kind == "purchase", weblog.FINISHED).when(kind == "error", weblog.FAILED)
        .otherwise("Page.frameNavigated")
    )
    redirect = F.struct(
        F.lit(302).alias("status"), F.concat(url, F.lit("#old")).alias("url"),
        F.create_map(F.lit("k"), k.cast("string")).alias("headers"),
    )
    params = F.struct(
        F.when(F.col("event_id") % 53 != 0, request_id).alias("requestId"),
        F.when(kind == "view", F.struct(F.concat(url, F.lit("#top")).alias("url"), F.lit("GET").alias("method"))).alias("request"),
        F.when((kind == "view") & (k % 2 == 0), redirect).alias("redirectResponse"),
        F.when(
            kind == "click",
            F.struct(
                F.when(k % 20 == 7, "").otherwise(url).alias("url"),
                (k + 200).alias("status"), mime.alias("mimeType"),
            ),
        ).alias("response"),
        F.when(kind == "purchase", F.col("value")).alias("encodedDataLength"),
        F.when(kind == "error", F.concat(F.lit("net::ERR_"), k)).alias("errorText"),
        F.when(kind == "error", k % 2 == 0).alias("canceled"),
    )
    message = F.to_json(F.struct(F.struct(method.alias("method"), params.alias("params")).alias("message")))
    return even_out(table(spark, sf_dir, "events"), "event_id").select(
        F.col("user_id").alias("capture_id"), F.col("event_id").alias("seq"), "ts",
        F.when(F.col("event_id") % 97 == 0, F.concat(F.lit("{cut"), message)).otherwise(message).alias("message"),
    )


def log_events(spark, sf_dir):
    return network_log.parse_messages(event_log(spark, sf_dir))


def bodies(spark, sf_dir):
    """One body per request with a click worth more than five; half of them base64."""
    text = F.concat(F.lit("cuerpo é "), F.col("n"))
    return (
        table(spark, sf_dir, "events")
        .filter((F.col("event_type") == "click") & (F.col("value") > 5))
        .groupBy(
            F.col("user_id").alias("capture_id"),
            F.concat_ws("-", "user_id", F.date_format("ts", "yyyyMMdd")).alias("request_id"),
        )
        .agg(F.max("event_id").alias("n"))
        .select(
            "capture_id", "request_id", (F.col("n") % 2 == 0).alias("base64_encoded"),
            F.when(F.col("n") % 2 == 0, F.base64(F.encode(text, "UTF-8"))).otherwise(text).alias("body"),
        )
    )


BODIES_SQL = """
bodies AS (SELECT user_id AS capture_id, user_id || '-' || strftime(ts, '%Y%m%d') AS request_id,
    octet_length(encode('cuerpo é ' || max(event_id)))::INTEGER AS bytes
  FROM events WHERE event_type = 'click' AND value > 5 GROUP BY ALL)
"""


@query(
    "parsed_log",
    f"WITH {LOG_SQL} SELECT event_type, count(*) AS eventos, count(DISTINCT request_id) AS peticiones "
    "FROM log GROUP BY 1",
)
def parsed_log(spark, sf_dir):
    """Messages that parse and name a request, by kind."""
    found = weblog.request_events(log_events(spark, sf_dir))
    kind = (
        F.when(F.col("method") == weblog.REQUEST, "view").when(F.col("method") == weblog.RESPONSE, "click")
        .when(F.col("method") == weblog.FINISHED, "purchase").otherwise("error")
    )
    return found.groupBy(kind.alias("event_type")).agg(
        F.count(F.lit(1)).alias("eventos"), F.countDistinct("request_id").alias("peticiones")
    )


@query(
    "request_records",
    f"""
    WITH {LOG_SQL}
    SELECT capture_id, request_id, first_seq, req_url, resp_url, status, mime_type,
      data_length, n_redirects, n_failures FROM records
    """,
)
def request_records(spark, sf_dir):
    return weblog.request_records(log_events(spark, sf_dir)).select(
        "capture_id", "request_id", "first_seq",
        F.col("request.url").alias("req_url"), F.col("response.url").alias("resp_url"),
        "response.status", "response.mime_type",
        F.col("loading.encoded_data_length").alias("data_length"), "n_redirects", "n_failures",
    )


@query(
    "redirect_hops",
    f"""
    WITH {LOG_SQL}
    SELECT capture_id, request_id, seq, url, 302 AS status, k::VARCHAR AS cabecera,
      row_number() OVER (PARTITION BY capture_id, request_id ORDER BY seq) - 1 AS hop
    FROM log WHERE event_type = 'view' AND k % 2 = 0
    """,
)
def redirect_hops(spark, sf_dir):
    return weblog.redirect_hops(log_events(spark, sf_dir)).select(
        "capture_id", "request_id", "seq", "url", "status",
        F.try_element_at("headers", F.lit("k")).alias("cabecera"), "hop",
    )


@query(
    "failures",
    f"""
    WITH {LOG_SQL}
    SELECT capture_id, request_id, seq, 'net::ERR_' || k AS error_text, k % 2 = 0 AS canceled
    FROM log WHERE event_type = 'error'
    """,
)
def failures(spark, sf_dir):
    return weblog.failures(log_events(spark, sf_dir)).select(
        "capture_id", "request_id", "seq", "error_text", "canceled"
    )


RESOURCE_SQL = f"""
{LOG_SQL.strip()},
{BODIES_SQL.strip()},
located AS (SELECT *, coalesce(nullif(resp_url, ''), nullif(req_url, '')) AS url FROM records),
firsts AS (SELECT capture_id, url, arg_min(request_id, first_seq) AS request_id, min(first_seq) AS first_seq,
    arg_min_null(status, first_seq) AS status, arg_min_null(mime_type, first_seq) AS mime_type
  FROM located WHERE url LIKE 'http://%' OR url LIKE 'https://%' GROUP BY ALL),
parts AS (SELECT f.*, bytes, regexp_extract(url, '^https?://([^/]*)', 1) AS host,
    regexp_extract(url, '/p/(\\d+)', 1) AS name, regexp_extract(url, '\\?(.*)$', 1) AS q,
    CASE WHEN mime_type LIKE 'text/html%' THEN '.html' WHEN mime_type = 'text/css' THEN '.css'
      WHEN mime_type = 'image/png' THEN '.png' ELSE '' END AS ext
  FROM firsts f LEFT JOIN bodies b USING (capture_id, request_id)),
resources AS (SELECT *, host || '/p/' || name || CASE WHEN url LIKE '%/p/' || name || '/%' THEN '/index' ELSE '' END
    || CASE WHEN q <> '' THEN '__q' || substr(sha256(q), 1, 12) ELSE '' END || ext AS relpath FROM parts)
"""


def found_resources(spark, sf_dir):
    return weblog.resources(
        weblog.request_records(log_events(spark, sf_dir)), bodies(spark, sf_dir)
    )


def kept_resources(spark, sf_dir):
    """The inventory written once, for queries that start several branches from it."""
    return materialise(found_resources(spark, sf_dir), "resources")


@query(
    "resource_inventory",
    f"""
    WITH {RESOURCE_SQL}
    SELECT capture_id, request_id, url, status, mime_type, bytes, relpath, '/' || relpath AS local_ref
    FROM resources WHERE bytes IS NOT NULL
    """,
)
def resource_inventory(spark, sf_dir):
    return weblog.saved(found_resources(spark, sf_dir)).select(
        "capture_id", "request_id", "url", "status", "mime_type", "bytes", "relpath", "local_ref"
    )


# Style sheets of a capture stand in for its missing references: each saved sheet names the
# next page of its site and an image nobody saved.
SHEET_SQL = """
sheets AS (SELECT capture_id, url, host FROM resources WHERE bytes IS NOT NULL AND mime_type = 'text/css'),
wanted AS (SELECT capture_id, 'https://' || host || '/p/1' AS url FROM sheets
  UNION SELECT capture_id, 'https://' || host || '/img/fondo.png' FROM sheets),
missing AS (SELECT * FROM wanted w WHERE NOT EXISTS (
  SELECT 1 FROM resources r WHERE r.capture_id = w.capture_id AND r.url = w.url AND bytes IS NOT NULL))
"""


def sheets(found):
    css = "a{background:url( '../img/fondo.png' )} b{background:URL(/p/1#x)} c{background:url(data:x)}"
    kept = weblog.saved(found).filter(references.is_style_sheet(F.col("mime_type"), F.col("relpath")))
    return kept.select("capture_id", "url", F.lit(css).alias("css"))


def missing_css(found):
    refs = references.css_refs(sheets(found), ["capture_id", "url"])
    resolved = references.resolve(refs, "url", out="destino").select(
        "capture_id", F.col("destino").alias("url")
    )
    known = weblog.url_map(found).select("capture_id", "url")
    return resolved.distinct().join(known, ["capture_id", "url"], "left_anti")


@query(
    "css_missing_refs",
    f"WITH {RESOURCE_SQL}, {SHEET_SQL} SELECT capture_id, url FROM missing",
)
def css_missing_refs(spark, sf_dir):
    return missing_css(kept_resources(spark, sf_dir))


@query(
    "capture_warnings",
    f"""
    WITH {RESOURCE_SQL}, {SHEET_SQL}
    SELECT capture_id, 'get_response_body' AS stage, 'No body captured' AS message, url, request_id
    FROM resources WHERE bytes IS NULL
    UNION ALL
    SELECT capture_id, 'rewrite_css_missing', 'No local mapping found', url, NULL FROM missing
    """,
)
def capture_warnings(spark, sf_dir):
    found = kept_resources(spark, sf_dir)
    return weblog.body_warnings(found).unionByName(
        weblog.missing_css_warnings(missing_css(found))
    )


@query(
    "capture_summary",
    f"""
    WITH {RESOURCE_SQL}, {SHEET_SQL}
    SELECT r.capture_id, count(bytes) AS saved_count,
      coalesce(any_value(m.n), 0) AS missing_refs_count,
      count(*) FILTER (bytes IS NULL) + coalesce(any_value(m.n), 0) AS warnings_count
    FROM resources r LEFT JOIN (SELECT capture_id, count(*) AS n FROM missing GROUP BY 1) m USING (capture_id)
    GROUP BY 1
    """,
)
def capture_summary(spark, sf_dir):
    found = kept_resources(spark, sf_dir)
    missing = missing_css(found)
    warnings = weblog.body_warnings(found).unionByName(weblog.missing_css_warnings(missing))
    return weblog.capture_summary(found, warnings, missing)


@query(
    "capture_manifest",
    f"""
    WITH {RESOURCE_SQL}, {SHEET_SQL},
    m AS (SELECT capture_id, count(*) AS n FROM missing GROUP BY 1)
    SELECT r.capture_id, count(bytes) AS saved_count, coalesce(any_value(m.n), 0) AS missing_refs_count,
      count(*) FILTER (bytes IS NULL) + coalesce(any_value(m.n), 0) AS warnings_count,
      arg_min(url, first_seq) AS root_url, arg_max(url, first_seq) AS final_url,
      arg_min(host, first_seq) FILTER (bytes IS NOT NULL) || '/index.final.html' AS final_html,
      arg_min(host, first_seq) FILTER (bytes IS NOT NULL) || '/index.offline.html' AS offline_html
    FROM resources r LEFT JOIN m USING (capture_id) GROUP BY 1
    """,
)
def capture_manifest(spark, sf_dir):
    """The first and the last address of a capture stand in for those it was opened at and ended on."""
    found = kept_resources(spark, sf_dir)
    missing = missing_css(found)
    warnings = weblog.body_warnings(found).unionByName(weblog.missing_css_warnings(missing))
    opened = found.groupBy("capture_id").agg(
        F.min_by("url", "first_seq").alias("root_url"), F.max_by("url", "first_seq").alias("final_url")
    )
    return weblog.manifest(found, warnings, missing, opened)


@query(
    "tree_listing",
    f"""
    WITH {RESOURCE_SQL}, kept AS (SELECT * FROM resources WHERE bytes IS NOT NULL),
    hosts AS (SELECT capture_id, arg_min(host, first_seq) AS host FROM kept GROUP BY 1)
    SELECT capture_id, relpath FROM kept
    UNION ALL SELECT capture_id, host || '/index.final.html' FROM hosts
    UNION ALL SELECT capture_id, host || '/index.offline.html' FROM hosts
    """,
)
def tree_listing(spark, sf_dir):
    return weblog.tree(kept_resources(spark, sf_dir))


IDLE_GAP = 7200


@query(
    "network_idle",
    """
    WITH g AS (SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS sig FROM events)
    SELECT user_id, min(ts) AS inicio,
      least(min(ts + INTERVAL 2 HOUR) FILTER (sig IS NULL OR sig - ts >= INTERVAL 2 HOUR),
            min(ts) + INTERVAL 6 HOUR) AS reposo,
      min(ts + INTERVAL 2 HOUR) FILTER (sig IS NULL OR sig - ts >= INTERVAL 2 HOUR)
        > min(ts) + INTERVAL 6 HOUR AS por_tope
    FROM g GROUP BY 1
    """,
)
def network_idle(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return weblog.network_idle(events, "user_id", gap_seconds=IDLE_GAP, cap_seconds=3 * IDLE_GAP)


PAGE_COMPLETE_SQL = """
WITH ready AS (SELECT user_id, min(ts) AS p FROM events WHERE event_type = 'signup' GROUP BY 1),
g AS (SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS sig
  FROM events WHERE event_type <> 'signup'),
c AS (SELECT user_id, min(ts) AS inicio, min(greatest(ts + INTERVAL 2 HOUR, p))
    FILTER (p IS NOT NULL AND (sig IS NULL OR sig >= greatest(ts + INTERVAL 2 HOUR, p))) AS quieto
  FROM g LEFT JOIN ready USING (user_id) GROUP BY 1)
SELECT user_id, inicio, least(quieto, inicio + INTERVAL 1440 HOUR) AS reposo,
  coalesce(quieto > inicio + INTERVAL 1440 HOUR, true) AS por_tope
FROM c
"""


@query("network_idle_page_complete", PAGE_COMPLETE_SQL)
def network_idle_page_complete(spark, sf_dir):
    """Signups stand in for the page reporting that it is complete."""
    kind = F.col("event_type")
    method = F.when(kind == "signup", "Page.loadEventFired").otherwise(F.concat(F.lit("Network."), kind))
    events = table(spark, sf_dir, "events").select("user_id", "ts", method.alias("method"))
    return weblog.network_idle(
        events, "user_id", gap_seconds=IDLE_GAP, cap_seconds=720 * IDLE_GAP,
        complete=F.col("method") == "Page.loadEventFired",
    )


SESSIONS_SQL = """
WITH g AS (SELECT user_id, ts, coalesce(ts - lag(ts) OVER w >= INTERVAL 2 HOUR, true) AS abre
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(abre::INTEGER) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM g)
SELECT user_id, min(ts) AS inicio, max(ts) + INTERVAL 2 HOUR AS fin, count(*) AS eventos
FROM s GROUP BY user_id, n
"""


@query("idle_sessions_batch", SESSIONS_SQL)
def idle_sessions_batch(spark, sf_dir):
    return weblog.idle_sessions(table(spark, sf_dir, "events"), "user_id", gap_seconds=IDLE_GAP)


def pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


@query("normalise_url", "SELECT page_id, regexp_replace(url, '#.*$', '') AS url FROM pages")
def normalise_url(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", urls.normalise_url(F.col("url")).alias("url"))


@query(
    "safe_relpath",
    r"""
    WITH p AS (SELECT page_id, regexp_extract(url, '^https?://([^/]*)', 1) AS host,
      regexp_extract(url, '^https?://[^/]*/([^?#]*)', 1) AS path,
      regexp_extract(url, '\?([^#]*)', 1) AS q FROM pages)
    SELECT page_id, host || '/' || regexp_replace(path, '\.html$', '') || CASE WHEN path LIKE '%/' THEN 'index' ELSE '' END
      || CASE WHEN q <> '' THEN '__q' || substr(sha256(q), 1, 12) ELSE '' END || '.html' AS relpath FROM p
    """,
)
def safe_relpath(spark, sf_dir):
    return pages(spark, sf_dir).select(
        "page_id", urls.safe_relpath(F.col("url"), F.lit("text/html; charset=utf-8")).alias("relpath")
    )


@query(
    "mime_ext",
    f"""
    WITH {LOG_SQL}
    SELECT mime_type, count(*) AS registros, CASE WHEN mime_type LIKE 'text/html%' THEN '.html'
      WHEN mime_type = 'text/css' THEN '.css' WHEN mime_type = 'image/png' THEN '.png' ELSE '' END AS ext
    FROM records GROUP BY ALL
    """,
)
def mime_ext(spark, sf_dir):
    records = weblog.request_records(log_events(spark, sf_dir))
    counted = records.groupBy(F.col("response.mime_type").alias("mime_type")).agg(
        F.count(F.lit(1)).alias("registros")
    )
    return counted.withColumn("ext", urls.mime_extension(F.col("mime_type")))


# Pages hold plain links only; frames, images and style links are put in to cover all kinds.
EXTRA = (
    '<link href="/css/a.css"><img data-src=\'img/x.png\' src="/img/&amp;amp;y.png" srcset="/s1.png 1x, /s2.png 2x">'
    '<video poster="//cdn.example.com/p.jpg"></video><p style="background:url(/bg.png)">'
    '<a href="mailto:a@b.c">m</a><a href="#x">x</a><meta http-equiv="refresh" content="5; url=/otra">'
    "<style>p{background:url('/st.png')}</style>"
)


def rich_pages(spark, sf_dir):
    html = F.replace("html", F.lit("</body>"), F.lit(EXTRA + "</body>"))
    return pages(spark, sf_dir).select("page_id", "url", html.alias("html"))


# (kind, raw, path on the page's own site when it resolves to one, else a whole URL)
EXTRA_REFS = [
    ("href", "/css/a.css"), ("data-src", "img/x.png"), ("src", "/img/&amp;amp;y.png"),
    ("srcset", "/s1.png"), ("srcset", "/s2.png"), ("poster", "//cdn.example.com/p.jpg"),
    ("style", "/bg.png"), ("href", "mailto:a@b.c"), ("href", "#x"), ("content", "/otra"),
    ("style_block", "/st.png"),
]
REFS_SQL = (
    "extra(kind, raw) AS (VALUES " + ", ".join(f"('{k}', '{r}')" for k, r in EXTRA_REFS) + "),\n"
    + r"""
    links AS (SELECT page_id, url AS base, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS raw FROM pages),
    refs AS (SELECT page_id, base, 'href' AS kind, raw FROM links
      UNION ALL SELECT page_id, url, kind, raw FROM pages, extra WHERE contains(html, '</body>')),
    resolved AS (SELECT page_id, base, kind, raw, CASE
        WHEN raw = 'img/x.png' THEN regexp_extract(base, '^([^?#]*/)[^/?#]*', 1) || raw
        WHEN raw LIKE '//%' THEN regexp_extract(base, '^[a-z]+:') || raw
        ELSE regexp_extract(base, '^https?://[^/?#]+') || replace(raw, '&amp;amp;', '&') END AS url
      FROM refs WHERE NOT regexp_matches(raw, '^(#|mailto:)'))
    """
)


def rich_refs(spark, sf_dir):
    return references.page_refs(rich_pages(spark, sf_dir), ["page_id", "url"])


@query("page_refs", f"WITH {REFS_SQL} SELECT page_id, kind, raw FROM refs")
def page_refs(spark, sf_dir):
    return rich_refs(spark, sf_dir).select("page_id", "kind", "raw")


@query(
    "css_refs",
    r"""
    WITH s AS (SELECT page_id, 'a{b:url(/u' || page_id || '.png)} c{d:URL( "v w.png" )} e{f:url(''x.gif'')}' AS css FROM pages)
    SELECT page_id, r AS raw FROM (SELECT page_id, unnest(['/u' || page_id || '.png', 'v w.png', 'x.gif']) AS r FROM s)
    """,
)
def css_refs(spark, sf_dir):
    css = F.concat(F.lit("a{b:url(/u"), "page_id", F.lit(".png)} c{d:URL( \"v w.png\" )} e{f:url('x.gif')}"))
    sheets_of = pages(spark, sf_dir).select("page_id", css.alias("css"))
    return references.css_refs(sheets_of, ["page_id"]).select("page_id", "raw")


@query(
    "page_sheet_refs",
    r"""
    SELECT page_id, len(regexp_extract_all(html, '(?s)<style>.*?</style>')) AS blocks,
      trim(trim(raw), '"''') AS raw
    FROM (SELECT page_id, html, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS raw FROM pages)
    """,
)
def page_sheet_refs(spark, sf_dir):
    """References of a sheet that is made of a page's own style blocks and a rule for each of its links."""
    blocks = refs.style_blocks(F.col("html"))
    links = F.filter(refs.page_references(F.col("html")), lambda x: x["kind"] == "href")
    rules = F.transform(links, lambda x: F.concat(F.lit('a{b:url("'), x["raw"], F.lit('")}')))
    own = pages(spark, sf_dir).select(
        "page_id", F.size(blocks).cast("long").alias("blocks"), F.concat_ws("\n", F.concat(blocks, rules)).alias("css")
    )
    return references.css_refs(own, ["page_id", "blocks"]).select("page_id", "blocks", "raw")


def resolved_rich(spark, sf_dir):
    return references.resolve(
        rich_refs(spark, sf_dir).withColumnRenamed("url", "base"), "base"
    )


@query("resolved_refs", f"WITH {REFS_SQL} SELECT page_id, kind, raw, url FROM resolved")
def resolved_refs(spark, sf_dir):
    return resolved_rich(spark, sf_dir).select("page_id", "kind", "raw", "url")


def saved_map(resolved):
    """Secure URLs count as saved, the others as missing."""
    secure = resolved.filter(F.col("url").startswith("https:")).select("url").distinct()
    return secure.withColumn(
        "local", F.concat(F.lit("/"), urls.safe_relpath(F.col("url"), F.lit("text/html")))
    )


@query(
    "missing_refs",
    f"""
    WITH {REFS_SQL}
    SELECT DISTINCT page_id, url FROM resolved r
    WHERE NOT EXISTS (SELECT 1 FROM resolved s WHERE s.url LIKE 'https:%' AND s.url = r.url)
    """,
)
def missing_refs(spark, sf_dir):
    resolved = materialise(resolved_rich(spark, sf_dir).select("page_id", "url"), "refs")
    return references.missing_refs(resolved, saved_map(resolved), ["page_id"])


@query(
    "missing_refs_split",
    f"""
    WITH {REFS_SQL}
    SELECT DISTINCT page_id, url FROM resolved r
    WHERE NOT EXISTS (SELECT 1 FROM resolved s WHERE s.url LIKE 'https:%' AND s.url = r.url)
    """,
)
def missing_refs_split(spark, sf_dir):
    """The same with the URLs that very many pages name kept out of the shuffle."""
    resolved = materialise(resolved_rich(spark, sf_dir).select("page_id", "url"), "refs")
    return references.missing_refs(resolved, saved_map(resolved), ["page_id"], split_hot=True)


@query(
    "missing_urls",
    f"""
    WITH {REFS_SQL}
    SELECT url, count(*) AS referencias FROM resolved r
    WHERE NOT EXISTS (SELECT 1 FROM resolved s WHERE s.url LIKE 'https:%' AND s.url = r.url) GROUP BY 1
    """,
)
def missing_urls(spark, sf_dir):
    resolved = materialise(resolved_rich(spark, sf_dir).select("page_id", "url"), "refs")
    return references.missing_urls(resolved, saved_map(resolved))


@query(
    "iframe_manifest",
    """
    SELECT page_id, page_id::INTEGER AS idx, url AS src, url LIKE 'https:%' AS same_origin,
      CASE WHEN url NOT LIKE 'https:%' THEN 'SecurityError' END AS error,
      CASE WHEN url LIKE 'https:%' AND page_id % 5 <> 0
        THEN 'iframes/iframe_' || format('{:03d}', page_id) || '.html' END AS saved_html FROM pages
    """,
)
def iframe_manifest(spark, sf_dir):
    same = F.col("url").startswith("https:")
    frames = pages(spark, sf_dir).select(
        "page_id", F.col("page_id").cast("int").alias("idx"), F.col("url").alias("src"),
        same.alias("same_origin"),
        F.when(same & (F.col("page_id") % 5 != 0), F.col("html")).alias("html"),
        F.when(~same, "SecurityError").alias("error"),
    )
    return references.iframe_manifest(frames)


KNOWN_SQL = """
known AS (SELECT DISTINCT url, '/l/' || substr(sha256(url), 1, 16) AS local FROM resolved WHERE url LIKE 'https:%')
"""
# What each kind of reference looks like in the page, before and after.
SUBSTITUTION_SQL = """
subs AS (SELECT page_id, CASE kind WHEN 'href' THEN 'href="' || raw || '"' WHEN 'src' THEN ' src="' || raw || '"'
      WHEN 'data-src' THEN 'data-src=''' || raw || '''' WHEN 'poster' THEN 'poster="' || raw || '"'
      WHEN 'srcset' THEN raw || ' ' WHEN 'style' THEN 'url(' || raw || ')'
      WHEN 'style_block' THEN 'url(''' || raw || ''')' ELSE 'url=' || raw || '"' END AS de,
    CASE kind WHEN 'href' THEN 'href="' || local || '"' WHEN 'src' THEN ' src="' || local || '"'
      WHEN 'data-src' THEN 'data-src=''' || local || '''' WHEN 'poster' THEN 'poster="' || local || '"'
      WHEN 'srcset' THEN local || ' ' WHEN 'style' THEN 'url("' || local || '")'
      WHEN 'style_block' THEN 'url("' || local || '")' ELSE 'url=' || local || '"' END AS a
  FROM (SELECT DISTINCT page_id, kind, raw, url FROM resolved) JOIN known USING (url)),
lists AS (SELECT page_id, list(de || chr(1) || a) AS l FROM subs GROUP BY 1)
"""
EXTRA_SQL = EXTRA.replace("'", "''")


def local_names(resolved):
    """The saved URLs under short local names."""
    name = F.concat(F.lit("/l/"), F.substring(F.sha2("url", 256), 1, 16))
    return saved_map(resolved).select("url", name.alias("local"))


@query(
    "rewritten_pages",
    rf"""
    WITH {REFS_SQL}, {KNOWN_SQL}, {SUBSTITUTION_SQL},
    rich AS (SELECT page_id, url, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host,
      replace(html, '</body>', '{EXTRA_SQL}</body>') AS html FROM pages)
    SELECT page_id, url, regexp_replace(
        list_reduce([html] || coalesce(l, []),
          lambda x, y: replace(x, split_part(y, chr(1), 1), split_part(y, chr(1), 2))),
        '(?i)(<head[^>]*>\s*)', '\1<base href="/' || host || '/">' || chr(10)) AS html
    FROM rich LEFT JOIN lists USING (page_id)
    """,
)
def rewritten_pages(spark, sf_dir):
    return references.rewrite(rich_pages(spark, sf_dir), local_names(resolved_rich(spark, sf_dir)))


@query(
    "rewritten_sheets",
    f"""
    WITH {REFS_SQL}, {KNOWN_SQL},
    p AS (SELECT page_id, url, regexp_extract(url, '^https?://[^/?#]+') AS o FROM pages)
    SELECT page_id, p.url, 'a{{b:' || coalesce('url("' || k1.local || '")', 'url(/The)')
      || '}} c{{d:' || coalesce('url("' || k2.local || '")', 'url( ''/and'' )')
      || '}} e{{f:url(/u' || page_id || '.png)}}' AS css
    FROM p LEFT JOIN known k1 ON k1.url = o || '/The' LEFT JOIN known k2 ON k2.url = o || '/and'
    """,
)
def rewritten_sheets(spark, sf_dir):
    css = F.concat(F.lit("a{b:url(/The)} c{d:url( '/and' )} e{f:url(/u"), "page_id", F.lit(".png)}"))
    own = pages(spark, sf_dir).select("page_id", "url", css.alias("css"))
    return references.rewrite_css(own, local_names(resolved_rich(spark, sf_dir)), "page_id")


# Pages as three captures: the first saves nothing, the others each under paths of their own.
CAPTURES_SQL = f"""
{REFS_SQL.strip()},
known AS (SELECT DISTINCT page_id % 3 AS capture_id, url,
    '/c' || (page_id % 3) || '/' || substr(sha256(url), 1, 16) AS local
  FROM resolved WHERE url LIKE 'https:%' AND page_id % 3 > 0)
"""


def capture_pages(spark, sf_dir):
    return rich_pages(spark, sf_dir).withColumn("capture_id", F.col("page_id") % 3)


def capture_refs(spark, sf_dir):
    found = references.page_refs(capture_pages(spark, sf_dir), ["capture_id", "page_id", "url"])
    return references.resolve(found.withColumnRenamed("url", "base"), "base")


def capture_map(resolved):
    own = resolved.filter(F.col("url").startswith("https:") & (F.col("capture_id") > 0))
    name = F.concat(F.lit("/c"), "capture_id", F.lit("/"), F.substring(F.sha2("url", 256), 1, 16))
    return own.select("capture_id", "url").distinct().withColumn("local", name)


@query(
    "capture_missing_refs",
    f"""
    WITH {CAPTURES_SQL}
    SELECT DISTINCT page_id % 3 AS capture_id, page_id, url FROM resolved r WHERE NOT EXISTS (
      SELECT 1 FROM known k WHERE k.capture_id = r.page_id % 3 AND k.url = r.url)
    """,
)
def capture_missing_refs(spark, sf_dir):
    """What one capture saved is missing in another that did not."""
    resolved = materialise(capture_refs(spark, sf_dir).select("capture_id", "page_id", "url"), "refs")
    return references.missing_refs(resolved, capture_map(resolved), ["page_id"], ["capture_id"])


@query(
    "capture_rewritten_pages",
    rf"""
    WITH {CAPTURES_SQL}, {SUBSTITUTION_SQL.replace("JOIN known USING (url)", "r JOIN known k ON k.url = r.url AND k.capture_id = page_id % 3")},
    rich AS (SELECT page_id, url, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host,
      replace(html, '</body>', '{EXTRA_SQL}</body>') AS html FROM pages)
    SELECT page_id % 3 AS capture_id, page_id, url, regexp_replace(
        list_reduce([html] || coalesce(l, []),
          lambda x, y: replace(x, split_part(y, chr(1), 1), split_part(y, chr(1), 2))),
        '(?i)(<head[^>]*>\s*)', '\1<base href="/' || host || '/">' || chr(10)) AS html
    FROM rich LEFT JOIN lists USING (page_id)
    """,
)
def capture_rewritten_pages(spark, sf_dir):
    """One URL has another local path in every capture."""
    return references.rewrite(
        capture_pages(spark, sf_dir), capture_map(capture_refs(spark, sf_dir)), scope=["capture_id"]
    )


@query(
    "skipped_log_entries",
    """
    WITH e AS (SELECT event_id, CASE event_id % 11 WHEN 1 THEN 'line is no log entry' WHEN 2 THEN 'no message'
      WHEN 3 THEN 'message has no method' WHEN 4 THEN 'message has no method' ELSE 'event' END AS motivo FROM events)
    SELECT motivo, count(*) AS n, sum(CASE WHEN motivo <> 'line is no log entry' THEN event_id END)::BIGINT AS claves FROM e GROUP BY 1
    """,
)
def skipped_log_entries(spark, sf_dir):
    """A written log with broken lines and messages: every entry is an event or is kept with its reason."""
    key = F.col("event_id") % 11
    method = F.when(key != 3, F.concat(F.lit("Network."), "event_type"))
    message = F.to_json(F.struct(F.struct(method.alias("method")).alias("message")))
    message = F.when(key == 4, F.substring(message, 1, 12)).when(key != 2, message)
    line = F.to_json(F.struct(F.lit(1).alias("capture_id"), F.col("event_id").alias("seq"), "ts", message.alias("message")))
    folder = scratch_path(spark, "lines")
    table(spark, sf_dir, "events").select(F.when(key == 1, F.concat(F.lit("x"), line)).otherwise(line).alias("value")).write.text(folder)
    events, skipped, counted = network_log.split_log(network_log.read_log(spark, folder))
    assert counted["leidas"] == counted["eventos"] + counted["omitidas"]
    both = events.select(F.lit("event").alias("motivo"), "seq").unionByName(skipped.select("motivo", "seq"))
    return both.groupBy("motivo").agg(F.count(F.lit(1)).alias("n"), F.sum("seq").alias("claves"))
