"""Operators for training text: brute force, exact round trips, and awkward rows."""

import base64
import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import xxhash
from oracle import compare, oracle_connection
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import bpe, chat, embeddings, lines, mixing, quality, recompression, simhash, suffixes, warc
from tidemark.llm.queries import ORACLES, QUERIES, VOCABULARY

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, fp string"
ODD = [None, "", " \n\t\n", "a " * 30000, "ä é x ß" * 40, "x" * 3000, "one two three\n" * 50]


def documents(spark, count=60, seed=1):
    """Small documents with copies, shared passages, NULLs, one repeated row and columns with clashing names."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    shared = [" ".join(rnd.choice(words) for _ in range(40)) for _ in range(4)]
    rows = [(i, t, "en", "s1", 0, "k", "f") for i, t in enumerate(ODD)]
    for i in range(len(ODD), count):
        text = "\n".join(
            rnd.choice(shared) if rnd.random() < 0.3 else " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 30)))
            for _ in range(rnd.randint(1, 6))
        )
        if rnd.random() < 0.2:
            text = rows[-1][1]
        rows.append((i, text, "en", rnd.choice(["s1", "s1", "s2", None]), 0, "k", "f"))
    rows.append(rows[-1])
    return rows, spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), oracle_connection(SF_DIR), ORACLES[name]) is None


@pytest.mark.parametrize("fn", [
    lambda d: lines.without_repeats(d), lambda d: mixing.mixed_sizes(d), lambda d: mixing.mix(d), lambda d: quality.judged(d),
    lambda d: quality.passing(d), lambda d: suffixes.without_repeats(d), lambda d: recompression.without_repeats(d),
    lambda d: simhash.near_duplicates(d), lambda d: simhash.representatives(d), lambda d: bpe.digests(d, VOCABULARY),
    lambda d: bpe.decode(bpe.encode(d, VOCABULARY), VOCABULARY),
])
def test_empty_and_null_tables(spark, fn):
    _, docs = documents(spark)
    assert fn(docs.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None,) * 7] * 3, DOCS)
    assert fn(nulls).count() in (0, 3)


CLASHES = [
    "own", "takes", "most", "key", "size", "of", "at", "target", "kept_id", "component_id", "fingerprint", "fp", "doc", "no", "__doc",
    "__own", "__lines", "__stay", "__gone", "__host", "__key", "__kept", "host", "digest", "kept", "h", "place", "range", "DOC_ID",
]


@pytest.mark.parametrize("fn", [mixing.mix, quality.passing, quality.without_common_lines, simhash.representatives, lines.cleaned])
def test_columns_of_any_name(spark, fn):
    """Other columns come through under their names, whatever helper columns there are."""
    docs = documents(spark, count=25)[1].drop("kept", "fp")
    plain = fn(docs)
    wide = docs.select("*", *(F.lit(f"of {c}") for c in CLASHES))
    wide = wide.toDF("doc_id", "text", "Text", "source", "n_chars", *CLASHES)
    made = fn(wide)
    assert made.columns == wide.columns
    rows = made.collect()
    assert all(tuple(r)[5:] == tuple(f"of {c}" for c in CLASHES) for r in rows)
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_counts_of_lines_take_the_place_of_given_ones(spark):
    docs = documents(spark, count=25)[1]
    made = lines.without_repeats(docs.withColumn("n_lines", F.lit("x")).withColumn("N_Removed", F.lit("y")))
    assert made.columns == [*docs.columns, "n_lines", "n_removed"]
    assert sorted(map(str, made.collect())) == sorted(map(str, lines.without_repeats(docs).collect()))


def brute_repeats(rows, cut, window):
    seen, out = {}, {}
    for doc, text in sorted({(r[0], r[1]) for r in rows}, key=lambda r: r[0]):
        symbols = cut((text or "").encode())
        gone = set()
        for i in range(len(symbols) - window + 1):
            if seen.setdefault(tuple(symbols[i : i + window]) if isinstance(symbols, list) else symbols[i : i + window], (doc, i)) != (doc, i):
                gone.update(range(i, i + window))
        out[doc] = symbols, gone
    return out


def test_recompression_against_brute_force(spark):
    rows, docs = documents(spark)
    want = brute_repeats(rows, lambda raw: raw.split(), 20)
    for r in recompression.without_repeats(docs).collect():
        words, gone = want[r.doc_id]
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        assert (r.n_words, r.n_removed, r.kept) == (len(words), len(gone), kept)


def test_suffixes_against_brute_force(spark):
    rows, docs = documents(spark)
    want = brute_repeats(rows, lambda raw: raw, 100)
    for r in suffixes.without_repeats(docs).collect():
        raw, gone = want[r.doc_id]
        kept = bytes(x for i, x in enumerate(raw) if i not in gone)
        spans = sum(i - 1 not in gone for i in gone)
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (len(raw), len(gone), spans, kept)


def test_hot_anchor_stays_bounded(spark, monkeypatch):
    """A passage of many different texts: no collection grows with the number of texts, and the rows stay right."""
    rnd = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz "
    shared = "".join(rnd.choice(letters) for _ in range(250))
    texts = ["".join(rnd.choice(letters) for _ in range(120)) for _ in range(150)]
    # Some have the same bytes beside the passage, so windows over its rims repeat too.
    texts[100:110] = ["x" * 20 + t[:60] + texts[3][-40:] for t in texts[100:110]]
    rows = [(i, t + shared + t[::-1]) for i, t in enumerate(texts)]
    bound, original = 1 << 12, suffixes.equal_windows

    def checked(strings, *rest):
        if sum(map(len, strings)) > 2 * bound:
            raise ValueError("a collection is above its bound")
        return original(strings, *rest)

    monkeypatch.setattr(suffixes, "COLLECTION", bound)
    monkeypatch.setattr(suffixes, "equal_windows", checked)
    want = brute_repeats(rows, lambda raw: raw, 100)
    for r in suffixes.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        raw, gone = want[r.doc_id]
        spans = sum(i - 1 not in gone for i in gone)
        kept = bytes(x for i, x in enumerate(raw) if i not in gone)
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (len(raw), len(gone), spans, kept)


def test_collection_is_a_sorted_suffix_array(tmp_path):
    rnd = random.Random(3)
    strings = [bytes(rnd.choice(b"ab\x00") for _ in range(rnd.randint(1, 40))) for _ in range(50)]
    symbols, prefixes = suffixes.collection_order(strings, 12, suffixes.Columns(f"file://{tmp_path}/c"))
    string, length = suffixes.suffix_array(symbols, len(strings), np.array([len(x) for x in strings]))
    found = [strings[s][len(strings[s]) - n :] for s, n in zip(string, length)]
    assert found == sorted(found)
    for a, b, p in zip(found, found[1:], prefixes[1:]):
        common = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert p == min(common, 12)


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_simhash_against_brute_force(spark):
    rows, docs = documents(spark)
    marks = {r[0]: brute_fingerprint(r[1]) for r in rows}
    root = {d: d for d in marks}
    for _ in marks:
        for a in marks:
            root[a] = min(root[b] for b in marks if (marks[a] ^ marks[b]).bit_count() <= 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {d: (f"{marks[d]:016x}", root[d]) for d in marks}


def test_trees_find_every_pair():
    rng = np.random.default_rng(2)
    points = rng.integers(0, 1 << 63, 800, dtype=np.uint64)
    points = np.unique(np.concatenate([points, points[:200] ^ np.uint64(5), points[:100] ^ np.uint64(1 << 60)]))
    top, merged = simhash.Tree(points[:100], 3), np.arange(len(points))
    which, leaf, visiting = top.routes(points, 2)
    for s in range(8):
        here = leaf == s
        u, v = simhash.linked(points[which[here & ~visiting]], points[which[here & visiting]], 2)
        merged = simhash.spanning(merged, np.searchsorted(points, u), np.searchsorted(points, v))
    want = np.arange(len(points))
    for i in range(len(points)):
        near = np.flatnonzero(simhash.distance(points, points[i]) <= 2)
        want = simhash.spanning(want, np.full(len(near), i), near)
    assert (merged == want).all()


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(150, 16))
    vectors = np.concatenate([base, base[:60] + 0.1 * rng.normal(size=(60, 16)), base[:20], base[:20] * 2])
    rows = [(i, v.astype(np.float32).tolist(), i % 3) for i, v in enumerate(vectors)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [float("nan")] * 16, 1), (n + 3, rows[0][1], None), (n + 4, [1.0, 2.0], 1)]
    got = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert len(got) == len(rows)
    links = {i: 0 for i in got}
    root = {i: i for i in got}
    pairs = []
    for i in range(n):
        for j in range(n):
            a, b = np.array(rows[i][1]), np.array(rows[j][1])
            if i != j and rows[i][2] == rows[j][2] and a @ b >= 0.93 * np.linalg.norm(a) * np.linalg.norm(b):
                links[i] += 1
                pairs.append((i, j))
    for _ in range(20):
        for i, j in pairs:
            root[i] = root[j] = min(root[i], root[j])
    assert sum(got[i].n_links for i in got) >= 0.9 * sum(links.values()) > 0
    assert all(got[i].n_links <= links[i] for i in got)
    assert all(got[i].component_id >= root[i] and got[i].kept == (got[i].component_id == i) for i in got)
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def table_of_vectors(spark, vectors, labels):
    rows = [(i, v.tolist(), label) for i, (v, label) in enumerate(zip(vectors.astype(np.float32), labels))]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)


def brute_links(vectors, least=0.93):
    """Links of each vector of one label, in double precision."""
    wide = embeddings.unit(vectors.astype(np.float32))
    return np.concatenate([(wide[a : a + 500] @ wide.T >= least).sum(axis=1) - 1 for a in range(0, len(wide), 500)])


def test_embeddings_of_a_tight_group_of_many_centres(spark):
    """No link is lost where centres cut a group of different near copies."""
    rng = np.random.default_rng(8)
    group = rng.normal(size=64) + 0.22 * rng.normal(size=(9000, 64))
    vectors = np.concatenate([group, rng.normal(size=(500, 64)), group[:20]])
    want = brute_links(vectors)
    got = {r.vec_id: r for r in embeddings.near_duplicates(table_of_vectors(spark, vectors, [1] * len(vectors))).collect()}
    assert [got[i].n_links for i in range(len(vectors))] == want.tolist()
    assert want[:9000].mean() > 4000 and sum(r.kept for r in got.values()) == 501


def test_parts_of_a_crowded_home(spark, monkeypatch):
    """Homes far above their size are split, and pairs over parts, homes and labels come out once."""
    monkeypatch.setattr(embeddings, "home_size", lambda most, dim: 60)
    rng = np.random.default_rng(9)
    vectors = np.concatenate([rng.normal(size=8) + 0.3 * rng.normal(size=(n, 8)) for n in (700, 200, 40, 5)] + [rng.normal(size=(300, 8))])
    labels = rng.integers(0, 2, len(vectors))
    got = {r.vec_id: r for r in embeddings.near_duplicates(table_of_vectors(spark, vectors, labels.tolist())).collect()}
    for label in (0, 1):
        at = np.flatnonzero(labels == label)
        wide = embeddings.unit(vectors[at].astype(np.float32))
        a, b = np.nonzero(wide @ wide.T >= 0.93)
        root = embeddings.spanning(np.arange(len(at)), a, b)
        assert [got[i].n_links for i in at] == (np.bincount(a, minlength=len(at)) - 1).tolist()
        assert [got[i].component_id for i in at] == at[root].tolist()


def test_audit_sees_lost_links(spark):
    rng = np.random.default_rng(10)
    vectors = np.concatenate([rng.normal(size=16) + 0.1 * rng.normal(size=(40, 16)) for _ in range(2)])
    given = table_of_vectors(spark, vectors, [0] * 40 + [1] * 40)
    links = embeddings.near_duplicates(given).select("vec_id", "n_links")
    whole = {r.label: (r.n_queries, r.wanted, r.recall) for r in embeddings.audit(given, links).collect()}
    assert whole == {k: (40, int(brute_links(vectors[40 * k : 40 * k + 40]).sum()), 1.0) for k in (0, 1)}
    lost = links.withColumn("n_links", F.when(F.col("vec_id") < 40, F.floor(F.col("n_links") / 2)).otherwise(F.col("n_links")))
    assert {r.label: r.recall < 0.6 for r in embeddings.audit(given, lost).collect()} == {0: True, 1: False}


@pytest.mark.parametrize("kind", ["array<float>", "array<double>"])
def test_embeddings_with_labels_of_other_types(spark, kind):
    rng = np.random.default_rng(11)
    near = rng.normal(size=16) + 0.05 * rng.normal(size=(30, 16))
    rows = [(i, v.tolist(), "a" if i < 15 else "b") for i, v in enumerate(near)] + [(30, near[0].tolist(), "a"), (31, near[0].tolist(), None)]
    rows += [(32, None, "none"), (33, None, "none"), rows[3]]
    given = spark.createDataFrame(rows, f"vec_id long, embedding {kind}, label string").repartition(3)
    links = embeddings.near_duplicates(given)
    got = sorted(map(tuple, links.collect()))
    assert got == sorted(
        [(i, 16, 0, i == 0) for i in (*range(15), 30, 3)] + [(i, 14, 15, i == 15) for i in range(15, 30)] + [(i, 0, i, True) for i in (31, 32, 33)]
    )
    unique = given.dropDuplicates(["vec_id"])
    audit = embeddings.audit(unique, embeddings.near_duplicates(unique)).collect()
    assert {(r.label, r.n_queries, r.wanted, r.recall) for r in audit} == {("a", 15, 15 * 15, 1.0), ("b", 15, 15 * 14, 1.0)}


def test_embeddings_that_are_all_null(spark):
    given = spark.createDataFrame([(1, None, None)] * 3, "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, embeddings.near_duplicates(given).collect())) == [(1, 0, 1, True)] * 3


def library_digests(rows):
    """Rows of ``bpe.digests`` by the library itself."""
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    own.no_truncation(), own.no_padding()
    out = []
    for doc, text in rows:
        ids = own.encode(text or "", add_special_tokens=False).ids
        decoded = own.decode(ids, skip_special_tokens=False)
        out.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    return sorted(out)


def test_bpe_digests_are_those_of_the_library(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = library_digests(map(tuple, docs.select("doc_id", "text").collect()))
    assert sorted(map(tuple, bpe.digests(docs, VOCABULARY).collect())) == want


def test_bpe_round_trip(spark):
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [*ODD, "It's <|endoftext|> I'LL Σίσυφος ΟΔΥΣΣΕΥΣ", "日本語 🙂 \x00 ﬁ ſ", "abc" * 2000, "'s'S ''"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY).collect():
        ids = own.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.decoded == own.decode(ids, skip_special_tokens=False)


def test_long_words_merge_like_short_ones():
    codec = bpe.Codec(bpe.read_vocabulary(VOCABULARY))
    rnd = random.Random(6)
    for _ in range(200):
        raw = bytes(rnd.choice(b"thein an") for _ in range(rnd.randint(1, 90)))
        part = [codec.inner[b] for b in raw[:-1]] + [codec.last[raw[-1]]]
        assert codec.merge_short(list(part)) == codec.merge_long(list(part))


def test_long_conversations(spark):
    """Work in a conversation grows with its turns, alternating or all of one role; NULL and empty texts among them."""
    n = 100000
    t = F.col("turn")
    text = F.when(t % 7 == 0, F.lit(None)).when(t % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("é[/OUT] 🙂 "), t.cast("string")))
    one = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"))
    rows = one.union(spark.range(n).select(F.lit(2), F.col("id"), F.lit("assistant"))).withColumn("text", text)
    begun = time.monotonic()
    made = chat.format_chats(rows)
    read = made.select("conv_id", "loss_spans", "formatted", chat.read_turns(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    got = {r.conv_id: r for r in read.collect()}
    assert time.monotonic() - begun < 60
    texts = ["" if i % 7 == 0 or i % 5 == 0 else f"é[/OUT] 🙂 {i}" for i in range(n)]
    assert [tuple(x) for x in got[1].t] == [("assistant" if i % 2 else "user", x) for i, x in enumerate(texts)]
    assert [tuple(x) for x in got[2].t] == [("assistant", x) for x in texts]
    assert got[1].loss == "".join(texts[1::2]) and got[2].loss == "".join(texts)
    for r in got.values():
        said = [r.formatted[s.start : s.start + s.chars].replace("[\\/OUT]", "[/OUT]") for s in r.loss_spans]
        assert said == (texts[1::2] if r.conv_id == 1 else texts)


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(none).select(chat.loss_text(F.col("formatted"), F.col("loss_spans"))).collect() == []


def test_chat_reads_back_what_it_formats(spark):
    rows = [
        (1, 2, "assistant", "b</s>[/OUT]"), (1, 1, "user", r"<\s> <\\/s> [INST] \[NEXT] [[NAME]"), (1, 3, "assistant", ""),
        (1, 3, "assistant", None), (1, 4, "to[NAME]ol", "[ROLE]x"), (1, 4, None, "y"), (None, None, "user", "z"), (2, 1, "system", "<s>"),
    ]
    made = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    read = made.select("conv_id", chat.read_turns(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    got = {r.conv_id: ([tuple(t) for t in r.t], r.loss) for r in read.collect()}
    key = lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or "")
    for conv in (1, 2, None):
        own = sorted((r for r in rows if r[0] == conv), key=key)
        turns = [(r[2] or "", r[3] or "") for r in own]
        assert got[conv] == (turns, "".join(t for role, t in turns if role == "assistant"))


def test_chunked_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 7)
    rows = [(1, "u", "same text é"), (2, None, "same text é"), (3, "u", None), (4, "u", ""), (5, "u\r\nv", "WARC/1.1\r\n\r\n" * 9), (5, "u", "WARC/1.1\r\n\r\n" * 9), (None, "u", "z")]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    want = []
    for page, _, html in rows:
        raw = (html or "").encode()
        first = min((r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None), default=None)
        kind = "response" if first in (None, page) else "revisit"
        want.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), kind, first if kind == "revisit" else None))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_archives_are_rolled(spark):
    """A payload of many chunks, and archives that are full after a few records; each record comes back once."""
    own = random.Random(5)
    long = "".join(own.choice("0123456789abcdef") for _ in range(100)) * (5 * warc.CHUNK // 100)
    rows = [(0, "u", long), (1, "u", long)] + [(i, "u", "".join(own.choice("abcdef é") for _ in range(300))) for i in range(2, 60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    got = sorted(map(tuple, warc.round_trip(pages, most=1000).collect()))
    digest = lambda x: base64.b32encode(hashlib.sha1(x.encode()).digest()).decode()
    want = [(i, len(h.encode()), digest(h), "response" if i != 1 else "revisit", 0 if i == 1 else None) for i, _, h in rows]
    assert got == want
    folder = warc.scratch_uri(spark, "archives")
    made = warc.write_archives(warc.chunk_rows(warc.planned(pages)), folder, 1000).collect()
    assert sum(r.records for r in made) == 60 and len(made) > 8 and max(r.records for r in made) < 20


def test_mix_takes_what_it_plans(spark):
    rows, docs = documents(spark)
    planned = mixing.mixed_sizes(docs).groupBy("doc_id").agg(F.sum("taken").alias("n")).where("n > 0")
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    taken = mixed.groupBy("doc_id").agg(F.sum(mixing.size_of(F.col("text"))).alias("n"))
    assert sorted(map(tuple, planned.collect())) == sorted(map(tuple, taken.collect()))
    for r in mixing.mixed_sizes(docs).groupBy("source", "target").agg(F.sum("taken").alias("n"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect():
        assert abs(r.n - r.target) <= 1 and r.over <= 0


def test_common_lines_are_cut(spark):
    """Boilerplate that differs in case and white space goes from all documents but the first of its host."""
    rows = [(i, f"own {i}\n{'  All  RIGHTS' if i % 2 else 'all rights'} \n\nend {i} é", "en", "s1" if i < 30 else None, 5, "k", "f") for i in range(55)]
    rows += [(60, None, "en", "s1", 5, "k", "f"), (61, "all rights", "en", "s2", 5, "k", "f"), (62, "all rights", "en", None, 5, "k", "f")]
    want = {}
    for doc, text, _, source, *_ in rows:
        cut = source != "s2" and doc not in (0, 30) and text is not None
        left = "\n".join(x for x in text.split("\n") if x.lower().split() != ["all", "rights"]) if cut else text
        want[doc] = left, len(left) if cut else 5
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    cut = quality.without_common_lines(docs)
    assert cut.columns == docs.columns and {r.doc_id: (r.text, r.n_chars) for r in cut.collect()} == want


def near(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    least = min(len(a), len(b))
    first = next((i for i in range(least) if a[i] != b[i]), least)
    last = next((i for i in range(least) if a[-1 - i] != b[-1 - i]), least)
    return first + last >= max(len(a), len(b)) - 1


def brute_lines(rows):
    seen, out = [], {}
    for doc, text in rows:
        kept = []
        for line in (text or "").split("\n") if text is not None else []:
            words = line.strip(" \t\r\f\v").split(" ")
            again = words != [""] and any(words == o or len(words) >= 8 and len(o) >= 8 and near(words, o) for o in seen)
            if words != [""]:
                seen.append(words)
            kept += [] if again else [line]
        out[doc] = None if text is None else "\n".join(kept)
    return out


def test_lines_one_word_apart(spark):
    rnd = random.Random(7)
    base = [[rnd.choice("abcdefgh") for _ in range(rnd.randint(6, 40))] for _ in range(30)]
    rows = []
    for doc in range(80):
        made = []
        for _ in range(rnd.randint(0, 5)):
            line = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 1, 2])):
                at = rnd.randrange(len(line))
                line[at : at + rnd.randint(0, 1)] = rnd.choice([[], ["x"], ["a"]])
                line = line or ["a"]
            made.append(" ".join(line))
        rows.append((doc, "\n".join(made)))
    rows += [(100, None), (101, ""), (102, " \n \n"), (103, "a b c d e f g " * 2000)]
    got = {r.doc_id: r.text for r in lines.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_lines(rows)


def test_pipeline_stages(spark):
    """Every stage by brute force on the rows that it was given."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, given = docs.columns, sorted(map(tuple, docs.collect()))
    stages = dict(corpus_pipeline.STAGES)
    passed = stages["quality_rules"](spark, docs, SF_DIR)
    kept = {r.doc_id for r in quality.judged(docs).where("kept").collect()}
    assert sorted(map(tuple, passed.collect())) == [r for r in given if r[0] in kept]
    lined = stages["line_dedup"](spark, passed, SF_DIR)
    assert {r.doc_id: r.text for r in lined.collect()} == brute_lines([r[:2] for r in given if r[0] in kept])
    single = stages["simhash_dedup"](spark, lined, SF_DIR)
    marks = {r.doc_id: brute_fingerprint(r.text) for r in lined.collect()}
    root = {d: d for d in marks}
    for _ in range(5):
        for a in marks:
            root[a] = min(root[b] for b in marks if (marks[a] ^ marks[b]).bit_count() <= 2)
    assert sorted(r.doc_id for r in single.collect()) == sorted(d for d in marks if root[d] == d)
    mixed = stages["source_mix"](spark, single, SF_DIR)
    assert lined.columns == single.columns == mixed.columns == columns
    plan = {r.doc_id: r.taken for r in mixing.mixed_sizes(single).collect() if r.taken}
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.encode().split())
    assert got == plan
    encoded = sorted(map(tuple, stages["bpe_encode"](spark, mixed, SF_DIR).collect()))
    assert encoded == library_digests(map(tuple, mixed.select("doc_id", "text").collect()))
