"""Registered queries of the operators and, where SQL can express one, the SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    bpe, chat, codes, embeddings, lines, mixing, privacy, quality, ranking, recompression, simhash, suffixes, warc,
)
from tidemark.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None) -> Callable:
    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


SQL_WORD = r"[^\x20\x09-\x0D]+"
SQL_SPACES = r"[\x20\x09-\x0D]+"

# Two lines one word apart have their first or last words, up to half of the shorter one, in common.
LINES_SQL = rf"""
WITH l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents),
w AS (SELECT doc_id, no, string_split(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), ' ') AS words FROM l),
first AS (SELECT words, len(words) AS n, min((doc_id, no)) AS place FROM w WHERE words <> [''] GROUP BY words),
halves AS (SELECT *, unnest(list_distinct([(m // 2, words[1:m // 2], true) FOR m IN [n, n - 1]]
    || [(m // 2, words[n - m // 2 + 1:n], false) FOR m IN [n, n - 1]])) AS half FROM first WHERE n >= {lines.LEAST_WORDS}),
pairs AS (SELECT DISTINCT a.words AS x, b.words AS y, a.n AS p, b.n AS q, a.place FROM halves a JOIN halves b
    ON a.half = b.half AND b.place < a.place AND abs(a.n - b.n) <= 1),
near AS (SELECT DISTINCT place FROM pairs WHERE
    coalesce(list_position([x[i] <> y[i] FOR i IN range(1, least(p, q) + 1)], true) - 1, least(p, q))
    + coalesce(list_position([x[p - i] <> y[q - i] FOR i IN range(0, least(p, q))], true) - 1, least(p, q))
    >= greatest(p, q) - 1),
gone AS (SELECT doc_id, no FROM w JOIN first USING (words) WHERE (doc_id, no) > place OR place IN (SELECT place FROM near)),
kept AS (SELECT doc_id, count(*) AS n_left, string_agg(line, chr(10) ORDER BY no) AS text FROM l
    WHERE (doc_id, no) NOT IN (SELECT (doc_id, no) FROM gone) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines,
    (coalesce(len(string_split(d.text, chr(10))), 0) - coalesce(n_left, 0))::BIGINT AS n_removed,
    CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept.text, '')) END AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
"""


@query("op1_line_dedup", LINES_SQL)
def op1(spark, sf_dir):
    made = lines.without_repeats(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


CHAT_SQL = r"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns AS (
    SELECT *, row_number() OVER w AS pos, lag(role) OVER w AS before FROM given
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
sized AS (
    SELECT *, length(regexp_replace(text, '([<\[])(\\*)(s>|/s>|(?:/?(?:SYS|INST|OUT|ROLE)|NEXT|NAME)\])', '\1\2\3+', 'g')) AS chars,
        CASE role WHEN 'system' THEN 'SYS' WHEN 'user' THEN 'INST' WHEN 'assistant' THEN 'OUT' ELSE 'ROLE' END AS mark,
        pos = 1 OR role <> before AS opens FROM turns),
framed AS (
    SELECT *, CASE WHEN opens THEN 2 * length(mark) + 5 ELSE length('[NEXT]') END
        + CASE WHEN opens AND mark = 'ROLE' THEN length(role) + length('[NAME]') ELSE 0 END AS frame FROM sized)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (sum(chars + frame) + length('<s></s>'))::BIGINT AS formatted_chars
FROM framed GROUP BY conv_id
"""


@query("op2_chat_formatting", CHAT_SQL)
def op2(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.sql(
        f"SELECT -1L AS conv_id, t.turn, t.role, '{probe}' AS text "
        "FROM (VALUES (0L, 'user'), (1L, 'assistant')) AS t(turn, role)"
    )
    made = chat.format_chats(given.unionByName(extra))
    read = made.select(
        "conv_id", "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


MIX_SQL = rf"""
WITH slim AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{SQL_WORD}')), 0)::BIGINT AS size,
        substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 16) AS key FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM slim GROUP BY source),
weighed AS (
    SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM sizes),
levels AS (
    SELECT *, 3 * source_size::DOUBLE AS cap, cap / weight AS fill, (sum(source_size) OVER ())::DOUBLE AS total,
        coalesce(sum(3 * source_size::DOUBLE) OVER w, 0) AS cap_before,
        sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weight_left
    FROM weighed WINDOW w AS (ORDER BY 3 * source_size::DOUBLE / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
aims AS (
    SELECT source, source_size, least(cap, weight * (SELECT max((total - cap_before) / weight_left) FROM levels
        WHERE (total - cap_before) / weight_left <= fill)) AS target FROM levels),
cuts AS (
    SELECT doc_id, size, source_size, target, round(target)::BIGINT AS budget,
        CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS epochs,
        coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING
            AND 1 PRECEDING), 0)::BIGINT AS before
    FROM slim s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target,
    (epochs * size + least(greatest(budget - epochs * source_size - before, 0), size))::BIGINT AS taken FROM cuts
"""


@query("op3_mixing", MIX_SQL)
def op3(spark, sf_dir):
    return mixing.mixed_sizes(table(spark, sf_dir, "documents")).drop("source")


QUALITY_SQL = rf"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{SQL_WORD}') AS w FROM documents),
lines AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS no FROM docs),
worded AS (SELECT *, len(regexp_extract_all(line, '{SQL_WORD}')) AS words, trim(regexp_replace(
    translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SQL_SPACES}', ' ', 'g'), ' ') AS plain
    FROM lines WHERE len(regexp_extract_all(line, '{SQL_WORD}')) > 0),
dup AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id, line ORDER BY no) AS k
    FROM worded) WHERE k > 1 GROUP BY doc_id),
grams AS (SELECT doc_id, i, w[i:i+2] AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM docs)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + s) AS n FROM twice, (VALUES (0), (1), (2)) v(s) GROUP BY doc_id),
common AS (SELECT source, plain, count(DISTINCT text) AS n, min(doc_id) AS first FROM worded GROUP BY source, plain),
hosts AS (SELECT source, count(DISTINCT text) AS a FROM docs GROUP BY source),
bad AS (SELECT c.source, plain, first FROM common c JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source
    WHERE n > {quality.LINE_DOCUMENTS} AND 100 * n > {quality.LINE_SHARE_PERCENT} * a),
gone AS (SELECT doc_id, sum(words) AS n FROM worded w JOIN bad b ON w.source IS NOT DISTINCT FROM b.source
    AND w.plain = b.plain WHERE doc_id <> first GROUP BY doc_id),
facts AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words, (len(w) - coalesce(gone.n, 0))::BIGINT AS words_left
    FROM docs d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, words_left,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
        AND 100 * words_left >= {quality.LEAST_LEFT_PERCENT} * n_words AS kept
FROM facts
"""


@query("op4_quality_rules", QUALITY_SQL)
def op4(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents"))


# Base32 by hand: each hex digit of the SHA-1 is four bits, each five bits a letter.
WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT hex, min(page_id) AS first FROM p GROUP BY hex),
bits AS (SELECT hex, string_agg(right('0000' || bin(('0x' || substr(hex, i::INT, 1))::BIGINT), 4), '' ORDER BY i) AS b
    FROM (SELECT hex FROM firsts), range(1, 41) r(i) GROUP BY hex),
spelled AS (SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum([
    (substr(b, (5 * i + k)::INT, 1) = '1')::INT * (1 << (5 - k)::INT) for k in [1, 2, 3, 4, 5]])::INT, 1), '' ORDER BY i) AS digest
    FROM bits, range(0, 32) r(i) GROUP BY hex)
SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, digest AS payload_digest,
    CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p JOIN firsts USING (hex) JOIN spelled USING (hex)
"""


@query("op6_warc", WARC_SQL)
def op6(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op8_simhash")
def op8(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("fp")


@query("op10_bpe")
def op10(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY)


@query("op7_recompression")
def op7(spark, sf_dir):
    made = recompression.without_repeats(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op5_suffix_array")
def op5(spark, sf_dir):
    made = suffixes.without_repeats(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op9_embeddings")
def op9(spark, sf_dir):
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


RANKED_SQL = r"""
WITH folded AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
docs AS (SELECT r, doc_id, len(terms)::BIGINT AS n, terms FROM folded WHERE len(terms) > 0),
corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
held AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weighed AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM held GROUP BY term), corpus),
scored AS (SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM asked JOIN held USING (term) JOIN weighed USING (term) JOIN docs USING (r), corpus GROUP BY item_id, doc_id, r),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0)
SELECT item_id, place::INT AS rank, doc_id, score FROM placed WHERE place <= 50
"""


@query("op11_ranked_search", RANKED_SQL)
def op11(spark, sf_dir):
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The contract's integer codebooks in SQL, each round a table of its own."""
    sql = f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
    [floor({scale} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
cut AS MATERIALIZED (SELECT r, p::INT AS p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS v FROM kept, range({parts}) t(p)),
book0 AS (SELECT p, (r - 1)::INT AS e, v FROM cut WHERE r <= {entries}),"""
    for i in range(rounds + 1):
        sql += f"""
near{i} AS MATERIALIZED (SELECT r, p, min(away) AS away, arg_min(e, (away, e)) AS e FROM (
    SELECT r, c.p, e, list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(c.v, b.v)])::BIGINT AS away
    FROM cut c JOIN book{i} b ON c.p = b.p) GROUP BY r, p),"""
        if i < rounds:
            sql += f"""
sum{i} AS (SELECT p, e, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS i
    FROM near{i} JOIN cut USING (r, p)) GROUP BY p, e, i),
mean{i} AS (SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM sum{i} GROUP BY p, e),
book{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.v, b.v) AS v FROM book{i} b LEFT JOIN mean{i} m USING (p, e)),"""
    return sql + f"""
coded AS (SELECT r, string_agg(lower(lpad(to_hex(e), 2, '0')), '' ORDER BY p) AS code, sum(away)::BIGINT AS error FROM near{rounds} GROUP BY r),
digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest
"""


@query("op12_vector_codes", codes_sql())
def op12(spark, sf_dir):
    return codes.compress(table(spark, sf_dir, "embeddings"))


@query("op13_pii")
def op13(spark, sf_dir):
    model = privacy.train(privacy.labelled_rows(spark))
    return privacy.digests(table(spark, sf_dir, "documents"), model)
