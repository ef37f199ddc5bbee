"""URLs, references, request records and idle points, against plain-Python brute force."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import markup, refs, urls
from tidemark.operators import references, weblog
from tidemark.sources import network_log

# What a URL's local path is without a type, and as HTML page.
PATHS = {
    "http://a.com": ("a.com/index", "a.com/index.html"),
    "http://a.com/": ("a.com/index", "a.com/index.html"),
    "https://a.com:81/x/y.html": ("a.com:81/x/y.html", "a.com:81/x/y.html"),
    "https://a.com/x/?q=1&b=2": ("a.com/x/index__q7d1ef6668072", "a.com/x/index__q7d1ef6668072.html"),
    "https://a.com/x;p=1": ("a.com/x", "a.com/x.html"),
    "https://u@a.com/a b/c.tar.gz?x": ("u@a.com/a b/c.tar__q2d711642b726.gz", "u@a.com/a b/c.tar__q2d711642b726.gz"),
    "https://a.com/%7Euser/%C3%A1.png": ("a.com/~user/á.png", "a.com/~user/á.png"),
    "https://a.com/a+b%2Bc": ("a.com/a+b+c", "a.com/a+b+c.html"),
    "https://a.com/x%zz/y%": ("a.com/x%zz/y%", "a.com/x%zz/y%.html"),
    "https://a.com/../../etc/pass": ("a.com/_/_/etc/pass", "a.com/_/_/etc/pass.html"),
    "https://a.com/a//b/./c": ("a.com/a/b/c", "a.com/a/b/c.html"),
    "https://a.com/<b>:\"|*": ("a.com/_b_____", "a.com/_b_____.html"),
    "https://a.com/.hidden": ("a.com/.hidden", "a.com/.hidden.html"),
    "https://a.com/name.": ("a.com/name.", "a.com/name..html"),
    "https://a.com/x.y/z": ("a.com/x.y/z", "a.com/x.y/z.html"),
    "/only/path": ("nohost/only/path", "nohost/only/path.html"),
    "data:text/plain,hi": ("nohost/text/plain,hi", "nohost/text/plain,hi.html"),
    "https://a.com/p?q=1#frag?x": ("a.com/p__q02f5e6e36c03", "a.com/p__q02f5e6e36c03.html"),
    "https://a.com/index.css;v=2?y#z": ("a.com/index__qa1fce4363854.css", "a.com/index__qa1fce4363854.css"),
}


def test_safe_relpath(spark):
    df = spark.createDataFrame([(u,) for u in PATHS], "u string")
    plain, page = (urls.safe_relpath(F.col("u"), F.lit(m)) for m in (None, "text/html; charset=utf-8"))
    got = {r.u: (r.a, r.b) for r in df.select("u", plain.alias("a"), page.alias("b")).collect()}
    assert got == PATHS


def test_extension_by_type(spark):
    want = {" TEXT/CSS ": "h/x.css", "image/png": "h/x.png", "x/unknown": "h/x", "application/octet-stream": "h/x"}
    df = spark.createDataFrame([(m,) for m in want], "m string")
    got = {r.m: r.p for r in df.select("m", urls.safe_relpath(F.lit("http://h/x"), F.col("m")).alias("p")).collect()}
    assert got == want


def test_normalise_url(spark):
    changed = {
        "https://a.com/p?q=1#frag?x": "https://a.com/p?q=1",
        "https://a.com/index.css;v=2?y#z": "https://a.com/index.css;v=2?y",
        "HTTP://A.com/x?#y": "http://A.com/x", "mailto:a@b#c": "mailto:a@b", "#x": "", "": "",
    }
    want = {u: u for u in PATHS} | changed
    df = spark.createDataFrame([(u,) for u in want], "u string")
    got = {r.u: r.n for r in df.select("u", urls.normalise_url(F.col("u")).alias("n")).collect()}
    assert got == want


BASES = ["https://a.com/x/y?z#w", "http://b.org", "https://a.com/p/"]
# A reference as it stands in a page, and what it is under each base.
RESOLVED = {
    "/a": ("https://a.com/a", "http://b.org/a", "https://a.com/a"),
    "b/c": ("https://a.com/x/b/c", "http://b.org/b/c", "https://a.com/p/b/c"),
    "../up": ("https://a.com/up", "http://b.org/up", "https://a.com/up"),
    "/a/../b": ("https://a.com/b", "http://b.org/b", "https://a.com/b"),
    "//cdn.x/y": ("https://cdn.x/y", "http://cdn.x/y", "https://cdn.x/y"),
    "https://z.com/q?x#y": ("https://z.com/q?x",) * 3,
    "?only=q": ("https://a.com/x/y?only=q", "http://b.org?only=q", "https://a.com/p/?only=q"),
    "#top": (None, None, None),
    "mailto:a@b": (None, None, None),
    " /sp ": ("https://a.com/sp", "http://b.org/sp", "https://a.com/sp"),
    "/a&amp;amp;b": ("https://a.com/a&b", "http://b.org/a&b", "https://a.com/a&b"),
    "JavaScript:x()": (None, None, None),
    "&#109;ailto:x": (None, None, None),
    "": ("https://a.com/x/y?z", "http://b.org", "https://a.com/p/"),
    "/x y": ("https://a.com/x y", "http://b.org/x y", "https://a.com/x y"),
    "http://z.com/?": ("http://z.com/",) * 3,
    "HTTP://Z/a#b": ("http://Z/a",) * 3,
    "data:x": (None, None, None),
    "tel:1": (None, None, None),
    "/a//b": ("https://a.com/a//b", "http://b.org/a//b", "https://a.com/a//b"),
    "b//c": ("https://a.com/x/b/c", "http://b.org/b/c", "https://a.com/p/b/c"),
    "./d": ("https://a.com/x/d", "http://b.org/d", "https://a.com/p/d"),
    "/e#f": ("https://a.com/e", "http://b.org/e", "https://a.com/e"),
    "/g.html?q=/./": ("https://a.com/g.html?q=/./", "http://b.org/g.html?q=/./", "https://a.com/g.html?q=/./"),
}


def test_resolve(spark):
    df = spark.createDataFrame([(r,) for r in RESOLVED], "raw string")
    out = df.select("raw", F.array(*[urls.resolve(F.col("raw"), F.lit(b)) for b in BASES]).alias("u"))
    assert {r.raw: tuple(r.u) for r in out.collect()} == RESOLVED


PAGE = (
    "<html><head>\n<meta http-equiv='Content-Security-Policy' content=\"default-src 'self'\">\n<title>t</title></head>"
    "<a HREF='/k'>k</a><a href=\"/none\">n</a><img data-src=/x src = '/k' srcset='/k 1x, /none 2x'>"
    "<p style='background:url( \"/k\" )'></p><style>@import url(/k); b{c:url('/none')}</style>"
    "<meta http-equiv=refresh content='3; URL=/k'><meta name=d content='/k'><a href='#z'>z</a>"
)


def test_rewrite_page(spark):
    pages = spark.createDataFrame([(1, "https://a.com/i", PAGE), (2, "https://a.com/j", "<p>x</p>"), (3, "x", None)],
                                  "page_id int, url string, html string")
    known = spark.createDataFrame([("https://a.com/k", "/a.com/k.html")], "url string, local string")
    out = {r.page_id: r.html for r in references.rewrite(pages, known).collect()}
    assert out[1] == (
        "<html><head>\n<base href=\"/a.com/\">\n<title>t</title></head>"
        "<a HREF='/a.com/k.html'>k</a><a href=\"/none\">n</a><img data-src=/x src = '/a.com/k.html'"
        " srcset='/a.com/k.html 1x, /none 2x'><p style='background:url(\"/a.com/k.html\")'></p>"
        "<style>@import url(\"/a.com/k.html\"); b{c:url('/none')}</style>"
        "<meta http-equiv=refresh content='3; URL=/a.com/k.html'><meta name=d content='/k'><a href='#z'>z</a>"
    )
    assert out[2] == '<base href="/a.com/">\n<p>x</p>' and out[3] is None


def test_rewrite_nothing_known_only_adds_base():
    html = "<head></head><a href='/x'>"
    assert markup.rewrite_page(html, {}, "h") == "<head><base href=\"/h/\">\n</head><a href='/x'>"


def test_sheet_slots():
    css = (
        "a{b:url(x.png)} c{d:URL( \"v w.png\" )} e{f:url('it)s.gif' )} g{h:url(\"open)} i{j:url(a\nb)} k{l:url( )}"
        "url('a'b') url("
    )
    assert [s.raw for s in markup.sheet_slots(css, 0, len(css))] == ["x.png", "v w.png", "it)s.gif", "open", "", "a'b"]
    assert markup.rewrite_css(css, {"it)s.gif": "/l"}).count('url("/l")') == 1


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, " " * 300_000, "a=" * 150_000, "url(" * 50_000, "<style>" * 40_000, "<meta x='" * 2_000):
        markup.rewrite_page(text, {"x": "y"}, "h")


PIECES = (
    ["<a ", "href=", "HREF = ", "src=", "x-src=", "srcset='", "style=\"", "content='", "3; URL=", "; url = ", "data-src='"]
    + ["/a b", "/k.png", " 2x, ", "\"", "'", "\"", "'", ">", "<style>", "<STYLE type=x>", "</style>", "<styles>", "<style"]
    + ["url(", "URL( ", ")", " )", "\n", " ", "é", "poster=\"", "onclick=\"", "=", ","]
)


def test_listing_finds_what_rewriting_replaces(spark):
    draw = random.Random(5)
    texts = ["".join(draw.choices(PIECES, k=draw.randint(0, 30))) for _ in range(20_000)]
    texts += [PAGE, "<style </style>url(x)", None]
    given = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    found = given.select("i", refs.page_references(F.col("t")).alias("page"), refs.sheet_references(F.col("t")).alias("sheet"))
    for r in found.collect():
        text = texts[r.i]
        if text is None:
            assert r.page is None and r.sheet is None
            continue
        assert [(x.kind, x.raw) for x in r.page] == [(s.kind, s.raw) for s in markup.page_slots(text)], text
        assert [x.raw for x in r.sheet] == [s.raw for s in markup.sheet_slots(text, 0, len(text))], text
        assert [x.pos for x in r.page] == list(range(len(r.page)))


def test_listing_of_long_texts(spark):
    texts = ["a" * 300_000, "a=" * 150_000, "url(" * 50_000, "url('" * 50_000, "<style>" * 40_000, "\"" * 200_000,
             "<style>" + "url(\"" * 30_000 + "</style>", "<style>" + "url(x)" * 30_000 + "</style>"]
    given = spark.createDataFrame([(t,) for t in texts], "t string")
    counts = [r.n for r in given.select(F.size(refs.page_references(F.col("t"))).alias("n")).collect()]
    assert sorted(counts) == [0] * 7 + [30_000]


def test_captures_do_not_share_their_urls(spark):
    pages = spark.createDataFrame(
        [(1, 1, "https://a.com/i", "<a href='/k'>"), (2, 1, "https://a.com/i", "<a href='/k'>")],
        "capture_id int, page_id int, url string, html string",
    )
    known = spark.createDataFrame(
        [(2, "https://a.com/k", "/a.com/k.html"), (3, "https://a.com/k", "/a.com/k.css")],
        "capture_id int, url string, local string",
    )
    scope = ["capture_id"]
    found = references.resolve(
        references.page_refs(pages.withColumnRenamed("url", "base"), ["capture_id", "page_id", "base"]), "base"
    )
    missing = references.missing_refs(found, known, ["page_id"], scope).collect()
    assert [tuple(r) for r in missing] == [(1, 1, "https://a.com/k")]
    assert [r.capture_id for r in references.missing_urls(found, known, scope).collect()] == [1]
    out = {r.capture_id: r.html for r in references.rewrite(pages, known, scope=scope).collect()}
    assert out == {
        1: "<base href=\"/a.com/\">\n<a href='/k'>", 2: "<base href=\"/a.com/\">\n<a href='/a.com/k.html'>",
    }


def test_log_parsing(spark):
    def msg(method, **params):
        import json

        return json.dumps({"message": {"method": method, "params": params}})

    log = [
        (1, 1, msg(weblog.REQUEST, requestId="a", request={"url": "http://x/1#f", "headers": {"h": "1"}})),
        (1, 2, msg(weblog.REQUEST, requestId="a", request={"url": "http://x/2"}, redirectResponse={"status": 301, "url": "http://x/1"})),
        (1, 3, msg(weblog.REQUEST, requestId="a", request={"url": "http://x/3"}, redirectResponse={"status": 302, "url": "http://x/2#g"})),
        (1, 4, msg(weblog.FAILED, requestId="a", errorText="E", canceled=True)),
        (1, 5, msg(weblog.RESPONSE, requestId="b", response={"url": "", "status": 200, "mimeType": "text/css"})),
        (1, 6, "{broken"), (1, 7, msg("Page.x", requestId="c")), (1, 8, msg(weblog.REQUEST, request={"url": "http://y"})),
        (1, 9, msg(weblog.FINISHED, requestId="b", encodedDataLength=12.0)), (1, 10, None),
    ]
    events = network_log.parse_messages(spark.createDataFrame(log, "capture_id long, seq long, message string"))
    records = {r.request_id: r for r in weblog.request_records(events).collect()}
    assert set(records) == {"a", "b"}
    a, b = records["a"], records["b"]
    assert (a.request.url, a.first_seq, a.n_redirects, a.n_failures, a.response) == ("http://x/3", 1, 2, 1, None)
    assert (b.request, b.response.mime_type, b.loading.encoded_data_length) == (None, "text/css", 12.0)
    hops = weblog.redirect_hops(events).orderBy("hop").collect()
    assert [(h.hop, h.status, h.url) for h in hops] == [(0, 301, "http://x/1"), (1, 302, "http://x/2")]
    assert weblog.failures(events).first().canceled is True


def test_first_record_of_a_url_wins(spark):
    records = spark.createDataFrame(
        [(1, "r1", 5, "http://x/a"), (1, "r0", 9, "http://x/a"), (1, "r2", 7, "ftp://x"), (2, "r1", 1, "http://x/a")],
        "capture_id long, request_id string, first_seq long, u string",
    ).selectExpr(
        "capture_id", "request_id", "first_seq", "named_struct('url', u) AS request",
        "named_struct('url', '', 'status', 200, 'mime_type', 'text/css', 'from_service_worker', false, 'from_disk_cache', true) AS response",
    )
    bodies = spark.createDataFrame(
        [(1, "r0", "late", False), (2, "r1", "w6k=", True)],
        "capture_id long, request_id string, body string, base64_encoded boolean",
    )
    out = {r.capture_id: (r.request_id, r.bytes, r.local_ref) for r in weblog.resources(records, bodies).collect()}
    assert out == {1: ("r1", None, "/x/a.css"), 2: ("r1", 2, "/x/a.css")}


def test_numbered_equals_row_number(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', cast(id % 7 as string)) AS k", "id * 5 AS seq")
    own = weblog.numbered(df, ["k"], "seq", "n", slice_rows=100)
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("seq")) - 1)
    assert sorted(map(tuple, own.collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_idle_and_sessions_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    start = datetime(2025, 1, 1, 10)
    rows = [
        (c, start + timedelta(milliseconds=500 * rng.randrange(0, 40 if c else 4000))) for c in range(6) for _ in range(60)
    ]
    df = spark.createDataFrame(rows, "capture_id int, ts timestamp_ntz")
    gap, want_idle, want_sessions = timedelta(seconds=2), {}, []
    for c in range(6):
        times = sorted(t for k, t in rows if k == c)
        ends = [a for a, b in zip(times, [*times[1:], None]) if b is None or b - a >= gap]
        cap = times[0] + timedelta(seconds=10)
        want_idle[c] = (times[0], min(ends[0] + gap, cap), ends[0] + gap > cap)
        opens = [times[0], *[b for a, b in zip(times, times[1:]) if b - a >= gap]]
        want_sessions += [(c, a, z + gap, sum(a <= t <= z for t in times)) for a, z in zip(opens, ends)]
    idle = {r.capture_id: (r.inicio, r.reposo, r.por_tope) for r in weblog.network_idle(df, cap_seconds=10).collect()}
    assert idle == want_idle
    assert sorted(map(tuple, weblog.idle_sessions(df).collect())) == sorted(want_sessions)
