"""Ranked search, vector codes and personal data: brute force, exact bounds, held-out accuracy, awkward rows."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import codes, privacy, ranking
from tidemark.llm.queries import QUERIES, table

SF_DIR = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# --- Ranked search

def folded(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, k):
    held = [(doc_id, Counter(folded(text)), len(folded(text))) for doc_id, text in docs if folded(text)]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, counts, n in held:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 20 * m))
                for t in set(folded(text)) if counts[t]
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        out += [(item_id, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


def search_rows(seed=3):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Été", "ÜBER", "x9", "日本"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 30)))) for i in range(400)]
    docs += [(500 + i, docs[7][1]) for i in range(80)] + [(i, docs[3][1]) for i in (3, 3)]
    docs += [(600, None), (601, ""), (602, " \n\t-;"), (603, "w1, W1;w1\x00w2"), (604, "w5 " * 20000), (None, docs[9][1]), (None, docs[9][1])]
    items = [(i, " ".join(rnd.choice(words) for _ in range(6))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "nowhere else"), (23, docs[7][1]), (24, "W1 w1 w1"), (0, items[0][1])]
    return docs, items


def test_search_against_brute_force(spark, monkeypatch):
    docs, items = search_rows()
    given = spark.createDataFrame([(*d, 1, "t") for d in docs], "doc_id long, text string, rank int, terms string").repartition(3)
    asked = spark.createDataFrame([(*i, 7) for i in items], "item_id long, text string, score int")
    want = brute_search(docs, items[:-1], 50)
    for small in (False, True):
        if small:  # many chunks, deep trees, several blocks of items, floors from a sample
            for name, value in (("CHUNK_ROWS", 64), ("BLOCK_TERMS", 16), ("FLOOR_ROWS", 50)):
                monkeypatch.setattr(ranking, name, value)
        got = ranking.search(given, asked)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=repr) == want


def test_search_of_empty_tables(spark):
    docs, items = search_rows()
    given = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert ranking.search(given.limit(0), asked).count() == 0
    assert ranking.search(given, asked.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, None)] * 3, "doc_id long, text string")
    assert ranking.search(nulls, asked).count() == 0
    assert ranking.search(given, nulls.withColumnRenamed("doc_id", "item_id")).count() == 0


def sparse_rows(rng, count, width):
    sizes = rng.integers(1, 12, count)
    groups = rng.integers(0, 8, count)
    term = [np.sort(rng.choice(width // 8, s, replace=False)) + g * (width // 8) for s, g in zip(sizes, groups)]
    return ranking.Rows(np.concatenate([[0], np.cumsum(sizes)]), np.concatenate(term), rng.integers(1, 10**6, sizes.sum()))


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(5)
    rows = sparse_rows(rng, 3000, 160)
    tree = ranking.BallTree(rows, 160)
    queries = np.where(rng.random((20, 160)) < 0.03, rng.integers(1, 15000, (20, 160)), 0)
    exact = np.array([tree.rows.dot(q) for q in queries])
    most = tree.bounds(queries)
    for node, (a, b) in enumerate(zip(tree.low, tree.high)):
        assert (exact[:, a:b].max(axis=1) <= most[node]).all()
        assert a == 0 or tree.parent[node] < node
    best = ranking.Best(np.ones(20, np.int64), 10)
    visited = best.search(tree, queries, np.arange(3000), np.zeros(3000, bool))
    leaves = sum(x < 0 for x in tree.left)
    assert visited < 0.7 * 20 * leaves
    for q, (score, doc_id, _) in zip(exact, best.held):
        given = q[np.argsort(tree.order)]
        order = np.lexsort((np.arange(3000), -given))
        order = order[given[order] > 0][:10]
        kept = np.lexsort((doc_id, -score))
        assert doc_id[kept].tolist() == order.tolist() and score[kept].tolist() == given[order].tolist()


def test_tree_of_copies_stays_flat():
    rows = ranking.Rows(np.arange(0, 4001 * 2, 2), np.tile([1, 4], 4000), np.full(8000, 900_000))
    tree = ranking.BallTree(rows, 5)
    assert len(tree.low) < 4 * 4000 / ranking.LEAF + 2


# --- Vector codes

def brute_codes(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(first[0][1])
    edges = [0, *itertools.accumulate(len(x) for x in np.array_split(np.arange(width), parts))]
    whole = lambda v: [math.floor(4096 * x) for x in v]
    ints = [whole(r[1]) for r in kept if len(r[1]) == width]
    cut = lambda v, p: v[edges[p] : edges[p + 1]]
    books = [[cut(whole(r[1]), p) for r in first[:entries]] for p in range(parts)]
    nearest = lambda v, book: min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for v in ints:
                own.setdefault(nearest(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(own[i]) for c in zip(*own[i])] if i in own else e for i, e in enumerate(books[p])]
    out, by_label = [], Counter()
    for vec_id, vector, label in kept:
        if len(vector) != width:
            out.append((vec_id, label, None, None))
            continue
        found = [nearest(cut(whole(vector), p), books[p]) for p in range(parts)]
        out.append((vec_id, label, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)))
        by_label[label] += out[-1][3]
    text = ",".join(str(x) for b in books for e in b for x in e)
    return [(v, c, e, by_label[label] if label in by_label else None) for v, label, c, e in out], hashlib.sha256(text.encode()).hexdigest()


VECTORS = "vec_id long, embedding array<float>, label int, code string, n long"


def vector_rows(count=300, width=20, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (9, width))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 9] + rng.normal(0, 0.05, width)], [0, 0, 1, None][i % 4]) for i in range(count)]
    rows[5] = (5, rows[0][1], 1)  # ties among the entries
    rows += [(40, rows[40][1], 2), (40, rows[40][1], 2), (None, rows[8][1], 0), (-3, None, 0), (-2, [None] * width, 1)]
    rows += [(-1, [float("nan")] * width, 1), (1000, [float("inf")] + [0.0] * (width - 1), 1), (1001, [1.0], 0), (1002, [0.0] * width, None)]
    return rows


@pytest.mark.parametrize("change", [None, "large", "few", "alike"])
def test_codes_against_brute_force(spark, change):
    rows = vector_rows()
    if change == "large":
        rows[30] = (30, [float(np.float32(3e12)), -3e9] + rows[30][1][2:], 0)
        rows[30] = (30, [float(np.float32(x)) for x in rows[30][1]], 0)
    if change == "few":
        rows = rows[:5]
    if change == "alike":
        rows = [(i, rows[0][1], 0) for i in range(40)]
    given = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS).repartition(3)
    got = codes.compress(given)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    want, digest = brute_codes(rows)
    made = got.collect()
    cap = codes.LONG
    want = [(v, c, None if e is None else min(e, cap), None if s is None else min(s, cap)) for v, c, e, s in want]
    assert sorted((tuple(r)[:4] for r in made), key=repr) == sorted(want, key=repr)
    assert {r.codebooks_sha256 for r in made} == {digest}


def test_codes_of_empty_tables(spark):
    given = spark.createDataFrame([(*r, "x", 1) for r in vector_rows()], VECTORS)
    assert codes.compress(given.limit(0)).count() == 0
    assert codes.compress(given.where("vec_id IN (-3, -2, -1, 1000)")).count() == 0
    none = spark.createDataFrame([(1, [], 0), (2, [], None)], "vec_id long, embedding array<float>, label int")
    assert {(r.vec_id, r.code, r.error) for r in codes.compress(none).collect()} == {(1, "00" * 8, 0), (2, "00" * 8, 0)}


def test_codes_decode_to_their_entries(spark):
    given = codes.usable(spark.createDataFrame(vector_rows(), "vec_id long, embedding array<float>, label int")).where(F.size("embedding") == 20)
    books = codes.fit(given)
    made = codes.decode(codes.encode(given, books), books)
    error = 0
    for r, g in zip(sorted(made.collect(), key=repr), sorted(given.collect(), key=lambda r: repr(r))):
        entries = [books[p][int(r.code[2 * p : 2 * p + 2], 16)] for p in range(8)]
        assert np.allclose(r.approximation, np.concatenate(entries).astype(float) / 4096)


def test_tree_of_entries_is_exact_and_leaves_out():
    rng = np.random.default_rng(6)
    for size, width, spread in ((1, 3, 9), (16, 8, 200), (256, 4, 5), (256, 8, 40), (200, 1, 3)):
        centres = rng.integers(-4000, 4000, (12, width))
        points = centres[rng.integers(0, 12, size)] + rng.integers(-spread, spread, (size, width))
        queries = np.concatenate([centres[rng.integers(0, 12, 700)] + rng.integers(-spread, spread, (700, width)), points])
        entry, away, taken = codes.Gnat(points).nearest(queries)
        all_away = ((queries[:, None] - points) ** 2).sum(axis=2)
        assert (entry == all_away.argmin(axis=1)).all() and (away == all_away.min(axis=1)).all()
        if size == 256:
            assert taken < 0.6 * len(queries) * size


# --- Personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    good = [
        lambda m: True, lambda m: all(int(x) <= 255 for x in m.split(".")),
        lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m)), lambda m: 10 <= len(digits(m)) <= 15,
    ]
    return sorted(
        (m.start(), k, m.end()) for k, p in enumerate((EMAIL, IP, CARD, PHONE)) for m in p.finditer(text) if good[k](m.group())
    )


def test_patterns_against_the_plain_ones():
    rnd = random.Random(8)
    alphabet = "a.b@1+ -(2_%3.@"
    for _ in range(20000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
        assert privacy.pattern_spans(text) == brute_spans(text), text
    for _ in range(3000):
        text = "".join(rnd.choice(["1", "0", "9", ".", "255", " ", "-", "+", "4111111111111111", "a@b.c"]) for _ in range(rnd.randint(0, 30)))
        assert privacy.pattern_spans(text) == brute_spans(text), text


@pytest.mark.parametrize("text", ["1" * 300_000, "a" * 300_000, "a@" * 100_000, "1." * 150_000, "+1" * 150_000, "1 " * 150_000, "+1(" + "1" * 300_000, "a.b-" * 70_000])
def test_long_runs_are_read_in_linear_time(text):
    privacy.pattern_spans(text)


@pytest.fixture(scope="module")
def model(spark):
    return privacy.train(privacy.labelled_rows(spark))


def plain_path(model, words):
    """Viterbi over every word of every document, one at a time, without cuts."""
    scores = privacy.total(model.rows_of(words.own()), model.weights)[words.shape]
    scores = scores + privacy.total(model.rows_of(words.beside(np.arange(len(scores))), privacy.OWN), model.weights[privacy.OWN :])
    made = []
    for doc in range(words.doc.max() + 1):
        own = scores[words.doc == doc]
        if not len(own):
            continue
        best, back = model.steps[0] + own[0], []
        for row in own[1:]:
            through = best[:, None] + model.steps
            back.append(through.argmax(axis=0))
            best = through.max(axis=0) + row
        path = [int((best + model.steps[:, 0]).argmax())]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        made += path[::-1]
    return made


def test_cut_chains_have_the_best_path(spark, model):
    texts = [r.text for r in privacy.labelled_rows(spark, 300, seed=77).collect()]
    texts += [" ".join(privacy.harmless(random.Random(i)) for i in range(400)), "", "one"]
    texts += [r.text for r in table(spark, SF_DIR, "documents").where("text IS NOT NULL").limit(60).collect()]
    words = privacy.words_of(*privacy.joined(texts))
    assert model.labels(words).tolist() == plain_path(model, words)


def test_held_out_accuracy(spark, model):
    """Spans of the field alone, on rows from another seed."""
    held = privacy.labelled_rows(spark, 500, seed=99).collect()
    texts = [r.text for r in held]
    data, ends = privacy.joined(texts)
    words = privacy.words_of(data, ends)
    found = privacy.field_spans(words, model.labels(words), np.concatenate([[0], ends]), data, texts)
    got = {(i, s, privacy.KINDS[k], e) for i, own in found.items() for s, k, e in own}
    want = {(i, s.start, s.kind, s.end) for i, r in enumerate(held) for s in r.spans}
    assert len(got & want) >= 0.98 * len(got) and len(got & want) >= 0.9 * len(want)


def test_chances_are_those_of_all_paths(model):
    """Forward and backward sums against the sum over every path of a short chain."""
    rng = np.random.default_rng(2)
    scores, n = rng.normal(size=(4, len(privacy.LABELS))), len(privacy.LABELS)
    chance, steps = privacy.expected(scores, model.steps, np.array([0]))
    sums, moves, whole = np.zeros((4, n)), np.zeros((n, n)), 0.0
    for path in itertools.product(range(n), repeat=4):
        full = (0, *path, 0)
        value = math.exp(sum(scores[i, y] for i, y in enumerate(path)) + sum(model.steps[a, b] for a, b in zip(full, full[1:])))
        whole += value
        for i, y in enumerate(path):
            sums[i, y] += value
        for a, b in zip(full, full[1:]):
            moves[a, b] += value
    assert np.allclose(chance, sums / whole) and np.allclose(steps, moves / whole)


TEXTS = [
    None, "", " \n", "Mail joe.b@mail.example.com, or call (988) 555-2485 now.", "é ñ +1 (826) 555-4081 190.137.223.2", "x" * 100_000,
    "4111 1111 1111 1111", "card 4111.1111.1111.1111!", "see 1.2.3 of 2024-05-06 at 10:30 for $1,200.00", "10.0.0.1 10.0.0.1", "a " * 60_000 + "a@b.cd",
]


def test_spans_of_awkward_rows(spark, model):
    given = spark.createDataFrame([(i, t, "k") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "k"), (None, TEXTS[6], "k")], "doc_id long, text string, spans string")
    rows = privacy.find(given.repartition(2), model).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        text = (TEXTS[r.doc_id] if r.doc_id is not None else TEXTS[6]) or ""
        fixed = [(s.start, privacy.KINDS.index(s.kind), s.end) for s in r.spans if s.found_by == "pattern"]
        assert fixed == brute_spans(text)
        assert [(s.start, privacy.KINDS.index(s.kind)) for s in r.spans] == sorted((s.start, privacy.KINDS.index(s.kind)) for s in r.spans)
    by_id = {r.doc_id: [(s.kind, TEXTS[r.doc_id][s.start : s.end], s.found_by) for s in r.spans] for r in rows if r.doc_id is not None}
    assert ("phone", "(988) 555-2485", "field") in by_id[3] and ("phone", "+1 (826) 555-4081", "field") in by_id[4]
    assert ("card", "4111.1111.1111.1111", "field") in by_id[7] and by_id[8] == [] and len(by_id[9]) == 2
    made = {r.doc_id: r.text for r in privacy.redacted(given.where("doc_id IS NOT NULL"), model).collect()}
    assert made[3] == "Mail [email], or call [phone] now." and made[0] is None and made[8] == TEXTS[8] and made[1] == ""


def test_tables_without_rows_or_labels(spark, model):
    given = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert privacy.digests(given.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        privacy.train(privacy.labelled_rows(spark).limit(0))


def test_digests_of_the_query(spark):
    texts = {r.doc_id: r.text or "" for r in table(spark, SF_DIR, "documents").collect()}
    rows = QUERIES["op13_pii"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute_spans(texts[r.doc_id])
        spelled = [f"{privacy.KINDS[k]}:{s}:{e}" for s, k, e in want]
        assert r.base_sha256 == hashlib.sha256(",".join(spelled).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in want) for i in range(4)]
        assert set(spelled) <= set(r.spans.split(","))  if spelled else True
