"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns find what has an exact form. The field finds the same four kinds where the form is looser (a phone
number without its plus, a card number with dots, a defanged address): it labels the words of a document, a span being
one B word and the I words behind it, from the shapes of a word and of its neighbours. It is trained in numpy on a
small labelled table and sent to the tasks, which score and decode whole batches of documents at once.

Decoding is exact. A word whose O score is so far ahead that no transition could make up for it is O on the best
path whatever its neighbours are; the chain is cut there, and only the runs between such words go through Viterbi, all
runs of a batch side by side. Every step is linear in the text.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.batches import map_batches

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{at}-{kind}" for kind in KINDS for at in "BI"))
#: Rows of the labelled table that the field is trained on, those of least hash; a bound, whatever the table holds.
MOST_LABELLED = 4096
SPAN = "struct<kind:string,start:long,end:long,found_by:string>"

# --- Patterns -------------------------------------------------------------------------------------------------

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: A run of digits that no address starts with is passed as a whole, so that long runs are read once.
ADDRESS = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
OTHERS = str.maketrans("", "", " ().-+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ is tried once: all starts before it share what follows."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def passes_luhn(digits: str) -> bool:
    doubled = (2 * int(d) - 9 * (d > "4") for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def is_part(number: str) -> bool:
    short = number.lstrip("0")
    return len(short) <= 3 and int(short or 0) <= 255


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of all spans of a fixed form, sorted."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in ADDRESS.finditer(text):
        if m.group(1) and all(map(is_part, m.group().split("."))):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m.group().translate(OTHERS) if m.end() - m.start() >= 14 else ""
        if 14 <= len(digits) <= 19 and passes_luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(m.group().translate(OTHERS)) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


# --- Words and shapes -----------------------------------------------------------------------------------------

SPACE, LETTER, DIGIT = 0, 1, 2
#: Class of a byte: letters (all bytes above ASCII too) and digits are one class each, any other is its own.
CLASS = np.array(
    [
        SPACE if c in b" \t\n\r\v\f" else LETTER if chr(c).isalpha() or c > 0x7F else DIGIT if 0x30 <= c <= 0x39 else 3 + c
        for c in range(256)
    ],
    np.uint8,
)
#: By class: signs that may stand around a word, and what may stand in a name or a number.
AROUND, NAME = np.zeros(256, bool), np.zeros(256, bool)
AROUND[CLASS[list(b"\"'<>[]{},;:.!?)")]] = True
NAME[[LETTER, DIGIT, *CLASS[list(b"._%-")]]] = True
#: Digits of a run that show in the fine shape; letters of a run show as one.
SHOWN_DIGITS = 4
#: Digits of a word, in steps.
DIGIT_STEPS = np.array([1, 2, 3, 4, 5, 7, 10, 11, 12, 14, 16, 17, 20])
MIX = np.uint64(0x9E3779B97F4A7C15)
EDGE = np.uint64(1)
#: Kinds of features that a word has by itself; the others are its neighbours'.
OWN = 4


@dataclass
class Words:
    """Words of a batch of texts, as ranges of its bytes; word i has the shape ``shape[i]``.

    The other fields describe the distinct shapes of the batch, the first one being letters alone. ``fine`` has all signs,
    and digits up to SHOWN_DIGITS of a run; ``coarse`` has no signs around the word and one digit of a run; ``loose``
    has one sign for each run of letters, digits and the signs of NAME.
    """

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    shape: np.ndarray
    fine: np.ndarray
    coarse: np.ndarray
    loose: np.ndarray
    digits: np.ndarray

    def own(self) -> list[np.ndarray]:
        """The features that a shape has by itself, for every distinct shape."""
        return [self.fine, self.coarse, self.loose, self.digits]

    def beside(self, at: np.ndarray) -> list[np.ndarray]:
        """The features that the words ``at`` have from their neighbours; beyond the text there is a shape of its own."""
        made = []
        for step in (-1, 1):
            other = np.clip(at + step, 0, len(self.doc) - 1)
            outside = (other == at) | (self.doc[other] != self.doc[at])
            for known in (self.coarse, self.digits):
                made.append(np.where(outside, EDGE, known[self.shape[other]]))
        return made


def shape_hashes(symbols: np.ndarray, shown: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word's shown symbols in their order; every word shows its first one."""
    place = np.cumsum(shown)
    rank = place - np.repeat(place[start], end - start)
    kept = rank[shown]
    powers = np.cumprod(np.full(int(kept.max()) + 1, MIX, np.uint64))
    terms = (symbols[shown].astype(np.uint64) + np.uint64(1)) * powers[kept]
    made = np.add.reduceat(terms, place[start] - 1)
    return made ^ (made >> np.uint64(29))


def shapes_of(symbols: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """(fine, coarse, loose, digits) of words that stand one behind the other in ``symbols``."""
    close = np.cumsum(size)
    open_ = close - size
    place = np.arange(len(symbols))
    fresh = np.ones(len(symbols), bool)
    fresh[1:] = symbols[1:] != symbols[:-1]
    fresh[open_] = True
    run = place - np.maximum.accumulate(np.where(fresh, place, 0))
    plain = symbols > DIGIT
    fine = plain | fresh | ((symbols == DIGIT) & (run < SHOWN_DIGITS))
    digits = np.searchsorted(DIGIT_STEPS, np.add.reduceat((symbols == DIGIT).astype(np.int64), open_), side="right")
    # Between the first and the last one that does not just surround a word; words of such signs alone stay whole.
    core = ~AROUND[symbols]
    low = np.minimum.reduceat(np.where(core, place, len(symbols)), open_)
    high = np.maximum.reduceat(np.where(core, place, -1), open_)
    low, high = np.where(high < 0, open_, low), np.where(high < 0, close - 1, high)
    within = (place >= np.repeat(low, size)) & (place <= np.repeat(high, size))
    core_size = high - low + 1
    core_close = np.cumsum(core_size)
    core_open = core_close - core_size
    inner = symbols[within]
    first = fresh[within]
    first[core_open] = True
    merged = np.where(NAME[inner], LETTER, inner)
    changed = np.ones(len(merged), bool)
    changed[1:] = merged[1:] != merged[:-1]
    changed[core_open] = True
    return (
        shape_hashes(symbols, fine, open_, close), shape_hashes(inner, (inner > DIGIT) | first, core_open, core_close),
        shape_hashes(merged, changed, core_open, core_close),
        # Apart from EDGE.
        digits.astype(np.uint64) + np.uint64(2),
    )


def words_of(data: np.ndarray, ends: np.ndarray) -> Words:
    """Words of texts that stand one behind the other in ``data``; text i ends at ``ends[i]``."""
    kind = CLASS[data]
    inside = kind != SPACE
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    heads = np.concatenate([[0], ends[:-1]])
    heads = heads[heads < len(data)]
    opens[heads] = inside[heads]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | opens[1:]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    doc = np.searchsorted(ends, start, side="right")
    shape = np.zeros(len(start), np.int64)
    known = shapes_of(np.array([LETTER], np.uint8), np.array([1]))
    marks = np.flatnonzero(kind > LETTER)
    if len(marks):
        # Only words with more than letters are looked into.
        marked = np.searchsorted(start, marks, side="right") - 1
        marked = marked[np.append(True, marked[1:] != marked[:-1])]
        size = end[marked] - start[marked]
        close = np.cumsum(size)
        at = np.arange(close[-1]) + np.repeat(start[marked] - (close - size), size)
        found = shapes_of(kind[at], size)
        together = found[0]
        _, first, which = np.unique(together, return_index=True, return_inverse=True)
        shape[marked] = which + 1
        known = tuple(np.concatenate([a, b[first]]) for a, b in zip(known, found))
    return Words(start, end, doc, shape, *known)


# --- The field ------------------------------------------------------------------------------------------------


@dataclass
class Field:
    """Known values and (value, label) weights of every kind of feature, and the (from, to) weights of labels."""

    values: list[np.ndarray]
    weights: list[np.ndarray]
    steps: np.ndarray
    certain: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        # By how much O has to lead label y so that y on the best path could be replaced by O, whatever is beside it.
        before = (self.steps - self.steps[:, :1]).max(axis=0)
        after = (self.steps - self.steps[:1, :]).max(axis=1)
        self.certain = before + after

    def rows_of(self, seen: list[np.ndarray], first: int = 0) -> list[np.ndarray]:
        """For each kind of feature, from number ``first`` on, the row of every value; 0 for one that training did not meet."""
        made = []
        for known, own in zip(self.values[first:], seen):
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            made.append(np.where(known[at] == own, at + 1, 0))
        return made

    def labels(self, words: Words) -> np.ndarray:
        """The best path of every document, with O before its first and behind its last word."""
        made = np.zeros(len(words.start), np.int64)
        if not len(made):
            return made
        own = total(self.rows_of(words.own()), self.weights)
        # What neighbours can add to another label's score against that of O, at most.
        most = sum((w - w[:, :1]).max(axis=0) for w in self.weights[OWN:])
        possible = (own[:, :1] - own - most <= self.certain + 1e-9)[:, 1:].any(axis=1)
        at = np.flatnonzero(possible[words.shape])
        scores = own[words.shape[at]] + total(self.rows_of(words.beside(at), OWN), self.weights[OWN:])
        open_ = (scores[:, :1] - scores <= self.certain + 1e-9)[:, 1:].any(axis=1)
        at, scores = at[open_], scores[open_]
        if len(at):
            starts = np.append(True, (np.diff(at) > 1) | (np.diff(words.doc[at]) > 0))
            made[at] = viterbi(scores, self.steps, np.flatnonzero(starts))
        return made


def total(rows: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
    made = np.zeros((len(rows[0]), len(LABELS)))
    for own, some in zip(rows, weights):
        made += some[own]
    return made


def viterbi(scores: np.ndarray, steps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best labels of chains that stand one behind the other, chain i from ``first[i]`` on, O before and behind each."""
    length = np.diff(np.append(first, len(scores)))
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    back = np.zeros(scores.shape, np.int8)
    best = steps[0] + scores[first]
    for step in range(1, int(length[0])):
        live = int(np.searchsorted(-length, -step, side="left"))
        through = best[:live, :, None] + steps
        back[first[:live] + step] = through.argmax(axis=1)
        best[:live] = through.max(axis=1) + scores[first[:live] + step]
    now = (best + steps[:, 0]).argmax(axis=1)
    made = np.zeros(len(scores), np.int64)
    for step in range(int(length[0]) - 1, -1, -1):
        live = int(np.searchsorted(-length, -step, side="left"))
        made[first[:live] + step] = now[:live]
        now[:live] = back[first[:live] + step, now[:live]]
    return made


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(x) for x in raw]).astype(np.int64)


def train(labelled: DataFrame, rounds: int = 80, rate: float = 0.1, decay: float = 1e-4) -> Field:
    """The field that fits ``labelled(text, spans)``; ``spans`` are structs of kind, start and end in code points.

    The likelihood's gradient comes from forward and backward sums over all chains at once; steps are scaled by
    their own history and all weights are pulled to zero by ``decay``. The same rows give the same field.
    """
    rows = labelled.select("text", "spans").where("text IS NOT NULL").orderBy(F.xxhash64("text"), "text").limit(MOST_LABELLED).collect()
    rows = [r for r in rows if r.text.strip(" \t\n\r\v\f")]
    if not rows:
        raise ValueError("no labelled text")
    words = words_of(*joined([r.text for r in rows]))
    wanted = np.zeros(len(words.start), np.int64)
    first = np.flatnonzero(np.append(True, words.doc[1:] != words.doc[:-1]))
    ends = np.append(first[1:], len(words.doc))
    for a, b in zip(first, ends):
        row = rows[words.doc[a]]
        base = words.start[a] - len(row.text[: len(row.text) - len(row.text.lstrip(" \t\n\r\v\f"))].encode())
        for kind, start, end in row.spans or ():
            low, high = (base + len(row.text[:x].encode()) for x in (start, end))
            held = np.flatnonzero((words.end[a:b] > low) & (words.start[a:b] < high)) + a
            number = KINDS.index(kind)
            wanted[held] = 2 + 2 * number
            wanted[held[:1]] = 1 + 2 * number
    everything = np.arange(len(wanted))
    seen = [x[words.shape] for x in words.own()] + words.beside(everything)
    values = [np.unique(x) for x in seen]
    model = Field(values, [np.zeros((len(v) + 1, len(LABELS))) for v in values], np.zeros((len(LABELS),) * 2))
    rows_of = model.rows_of(seen)
    # Words in the order of each feature's value, so that sums by value are sums of runs.
    orders = [np.argsort(own, kind="stable") for own in rows_of]
    runs = [np.flatnonzero(np.append(True, np.diff(own[order]) > 0)) for own, order in zip(rows_of, orders)]
    truth = np.eye(len(LABELS))[wanted]
    before = np.where(np.append(True, words.doc[1:] != words.doc[:-1]), 0, np.roll(wanted, 1))
    given = np.zeros_like(model.steps)
    np.add.at(given, (before, wanted), 1)
    np.add.at(given, (wanted[ends - 1], 0), 1)
    learned = [*model.weights, model.steps]
    history = [np.zeros_like(w) for w in learned]
    drift = [np.zeros_like(w) for w in learned]
    for turn in range(1, rounds + 1):
        chance, steps = expected(total(rows_of, model.weights), model.steps, first)
        gap = truth - chance
        slopes = []
        for own, order, run, weights in zip(rows_of, orders, runs, model.weights):
            slope = np.zeros_like(weights)
            slope[own[order[run]]] = np.add.reduceat(gap[order], run, axis=0)
            slopes.append(slope)
        slopes.append(given - steps)
        for weights, slope, m, v in zip(learned, slopes, drift, history):
            slope = slope / len(rows) - decay * weights
            m += 0.1 * (slope - m)
            v += 0.01 * (slope * slope - v)
            weights += rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-6)
    return Field(model.values, model.weights, model.steps)


def expected(scores: np.ndarray, steps: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance of every label at every word, and expected counts of all steps between labels."""
    length = np.diff(np.append(first, len(scores)))
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    shift = scores.max(axis=1, keepdims=True)
    point, move = np.exp(scores - shift), np.exp(steps - steps.max())
    ahead, behind = np.zeros(scores.shape), np.zeros(scores.shape)
    live_at = [int(np.searchsorted(-length, -step, side="left")) for step in range(int(length[0]))]
    now = move[0] * point[first]
    for step, live in enumerate(live_at):
        if step:
            now = (now[:live] @ move) * point[first[:live] + step]
        now = now / now.sum(axis=1, keepdims=True)
        ahead[first[:live] + step] = now
    after = np.tile(move[:, 0], (len(first), 1))
    counts = np.zeros(steps.shape)
    for step in range(int(length[0]) - 1, -1, -1):
        live = live_at[step]
        at = first[:live] + step
        behind[at] = after[:live] / after[:live].sum(axis=1, keepdims=True)
        if step:
            pull = point[at] * behind[at]
            both = ahead[at - 1][:, :, None] * move * pull[:, None, :]
            counts += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            after[:live] = pull @ move.T
    chance = ahead * behind
    chance /= chance.sum(axis=1, keepdims=True)
    counts[0] += chance[first].sum(axis=0)
    counts[:, 0] += chance[first + length - 1].sum(axis=0)
    return chance, counts


# --- The labelled table ---------------------------------------------------------------------------------------


def written(rnd: random.Random, count: int = 1, alphabet: str = "abcdefghijklmnopqrstuvwxyz") -> str:
    return " ".join("".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 10))) for _ in range(count))


def number(rnd: random.Random, size: int) -> str:
    return str(rnd.randint(1, 9)) + "".join(rnd.choice("0123456789") for _ in range(size - 1))


def personal(rnd: random.Random, kind: str) -> str:
    """A value in one of the forms that people write."""
    name, host = written(rnd), f"{written(rnd)}{rnd.choice(['', number(rnd, 1)])}.{rnd.choice(['example', written(rnd)])}"
    user = rnd.choice([name, f"{name}.{written(rnd)}", f"{name}.{number(rnd, 2)}", f"{name}{number(rnd, 3)}", f"{name}_{written(rnd)}"])
    if kind == "email":
        return rnd.choice([f"{user}@{host}.com", f"{user}@{host}", f"{user}(at){host}.org", f"{user}[at]{host}.net", f"{user}@{name}"])
    if kind == "ip":
        return rnd.choice([".", ".", "[.]", "(.)"]).join(str(rnd.randint(0, 255)) for _ in range(4))
    if kind == "card":
        body = number(rnd, 15)
        digits = next(body + d for d in "0123456789" if passes_luhn(body + d))
        return rnd.choice(["", " ", "-", "."]).join(digits[i : i + 4] for i in range(0, 16, 4))
    area, mid, last, land = number(rnd, 3), number(rnd, 3), number(rnd, 4), number(rnd, rnd.randint(1, 2))
    plain = rnd.choice([f"({area}) {mid}-{last}", f"{area}-{mid}-{last}", f"{area}.{mid}.{last}", f"({area}){mid}-{last}", f"{area} {mid} {last}"])
    return rnd.choice([plain, plain, f"+{land} {plain}", f"+{land}-{area}-{mid}-{last}", f"00{land} {plain}", f"{land} {plain}"])


def harmless(rnd: random.Random) -> str:
    """Numbers and signs that are nobody's data."""
    n = lambda low, high: rnd.randint(low, high)
    return rnd.choice([
        lambda: number(rnd, n(1, 13)), lambda: f"{n(1, 28)}/{n(1, 12)}/{n(1900, 2099)}", lambda: f"{n(1900, 2099)}-{n(10, 12)}-{n(10, 28)}",
        lambda: f"{n(0, 23)}:{n(10, 59)}", lambda: f"{n(1, 20)}.{n(0, 20)}", lambda: f"{n(1, 20)}.{n(0, 20)}.{n(0, 20)}",
        lambda: f"{n(1, 20)}.{n(0, 9)}.", lambda: f"{n(1, 20)}.", lambda: f"${n(1, 999)},{number(rnd, 3)}.{number(rnd, 2)}",
        lambda: f"{n(1, 999)}-{n(1, 999)}", lambda: f"{n(1, 100)}%", lambda: f"#{number(rnd, n(1, 8))}", lambda: f"({n(1, 99)})",
        lambda: f"({n(1900, 2099)})", lambda: f"@{written(rnd)}", lambda: written(rnd, 1, "0123456789abcdef") + number(rnd, 2) + "f",
        lambda: f"{written(rnd).upper()}-{number(rnd, 4)}", lambda: f"{written(rnd)}={written(rnd, 1, '0123456789abcdef')}",
        lambda: f"978-{n(0, 9)}-{number(rnd, 2)}-{number(rnd, 6)}-{n(0, 9)}", lambda: f"{written(rnd)}({n(1, 9)})", lambda: f"[{n(1, 99)}]",
        lambda: f"{number(rnd, 3)} {number(rnd, 3)}", lambda: f"{number(rnd, 4)} {number(rnd, 4)}", lambda: f"{number(rnd, 1)} {number(rnd, 3)} {number(rnd, 3)}",
        lambda: f"+{n(1, 99)}", lambda: f"+{n(1, 9)}.{n(0, 99)}", lambda: " ".join(number(rnd, n(1, 3)) for _ in range(n(2, 6))),
        lambda: f"https://{written(rnd)}.{written(rnd)}/{number(rnd, 4)}", lambda: f"{n(1, 90)}.{number(rnd, 4)}, {n(1, 90)}.{number(rnd, 4)}",
        lambda: number(rnd, n(17, 30)), lambda: f"({written(rnd)})", lambda: f"{written(rnd)}.{written(rnd)}",
    ])()


def labelled_rows(spark: SparkSession, count: int = 1000, seed: int = 13) -> DataFrame:
    """A small labelled table (text, spans): running words, with personal data and harmless numbers among them."""
    rnd = random.Random(seed)
    rows = []
    for _ in range(count):
        text, spans = "", []
        for piece in range(rnd.randint(2, 5)):
            text += ("" if not piece else rnd.choice([" ", " ", "\n"])) + written(rnd, rnd.randint(1, 4), "abcdeéioußñ" if rnd.random() < 0.2 else "abcdefghinorst")
            drawn = rnd.random()
            if drawn < 0.35:
                kind = rnd.choice(KINDS)
                text += rnd.choice([" ", " ", ": ", "\n", ", "]) + rnd.choice(["", "", "", "<", "\""])
                value = personal(rnd, kind)
                spans.append((kind, len(text), len(text) + len(value)))
                text += value + rnd.choice(["", "", "", ".", ",", ";", ">", "\""])
            elif drawn < 0.8:
                text += " " + harmless(rnd) + rnd.choice(["", "", ",", ".", ")"])
        rows.append((text, spans))
    return spark.createDataFrame(rows, "text string, spans array<struct<kind:string,start:long,end:long>>")


# --- Documents ------------------------------------------------------------------------------------------------

OUTER = "\"'<>[]{},;:.!?"
INNER = {
    "ip": re.compile(r"[0-9].*[0-9]", re.S), "card": re.compile(r"[0-9].*[0-9]", re.S), "phone": re.compile(r"[+(]{0,2}[0-9].*[0-9]", re.S),
}
NOT_DIGITS = re.compile(r"[^0-9]+")


def narrowed(text: str, kind: int, start: int, end: int) -> tuple[int, int] | None:
    """The labelled words without what stands around the value; None where it cannot be of its kind.

    A card number has to pass Luhn, an address to have four parts up to 255, a phone number 10 to 15 digits.
    """
    name, value = KINDS[kind], text[start:end]
    if name == "email":
        start += len(value) - len(value.lstrip(OUTER + "("))
        end -= len(value) - len(value.rstrip(OUTER + ")"))
        held = text[start:end]
        return (start, end) if any(c in held for c in "@([") and not any(c in held for c in " \t\n\r\v\f") else None
    found = INNER[name].search(value)
    if not found:
        return None
    value = found.group()
    if len(value) > 64:
        return None
    digits = NOT_DIGITS.sub("", value)
    numbers = [x for x in NOT_DIGITS.split(value) if x]
    good = {
        "ip": len(numbers) == 4 and all(map(is_part, numbers)),
        "card": 14 <= len(digits) <= 19 and passes_luhn(digits),
        "phone": 10 <= len(digits) <= 15,
    }[name]
    return (start + found.start(), start + found.end()) if good else None


def field_spans(words: Words, labels: np.ndarray, heads: np.ndarray, data: np.ndarray, texts: list[str]) -> dict[int, list[tuple[int, int, int]]]:
    """For each text (start, number of the kind, end) of what the field labelled, in code points."""
    at = np.flatnonzero(labels)
    if not len(at):
        return {}
    kind = (labels[at] - 1) // 2
    opens = (labels[at] - 1) % 2 == 0
    opens[0] = True
    opens[1:] |= (np.diff(at) > 1) | (np.diff(kind) != 0) | (np.diff(words.doc[at]) > 0)
    firsts = np.flatnonzero(opens)
    lasts = np.append(firsts[1:], len(at)) - 1
    made: dict[int, list[tuple[int, int, int]]] = {}
    places: dict[int, np.ndarray] = {}
    for a, b in zip(firsts, lasts):
        doc, low, high = int(words.doc[at[a]]), words.start[at[a]], words.end[at[b]]
        if doc not in places:
            own = data[heads[doc] : heads[doc + 1]]
            places = {doc: np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])}
        start, end = (int(places[doc][x - heads[doc]]) for x in (low, high))
        span = narrowed(texts[doc], int(kind[a]), start, end)
        if span:
            made.setdefault(doc, []).append((span[0], int(kind[a]), span[1]))
    return made


def find(docs: DataFrame, model: Field) -> DataFrame:
    """doc_id, spans of every row: array of kind, start and end (code points, end exclusive) and ``found_by``.

    Spans of the patterns always stay; the field adds its own where they meet no other span. Spans are sorted by start,
    then by kind. A NULL or empty text has none. Repeated rows stay repeated; ``doc_id`` is kept as it is, NULL too.
    """

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = [x or "" for x in part.column(1).to_pylist()]
        data, ends = joined(texts)
        words = words_of(data, ends)
        heads = np.concatenate([[0], ends])
        added = field_spans(words, model.labels(words), heads, data, texts)
        telling = np.zeros(len(texts), bool)
        digit = (data >= 0x30) & (data <= 0x39) | (data == 0x40)
        telling[np.searchsorted(ends, np.flatnonzero(digit), side="right")] = True
        out = []
        for doc, text in enumerate(texts):
            fixed = pattern_spans(text) if telling[doc] else []
            spans = [(s, k, e, "pattern") for s, k, e in fixed]
            taken = sorted((s, e) for s, _, e in fixed)
            for s, k, e in added.get(doc, ()):
                if not meets(taken, s, e):
                    spans.append((s, k, e, "field"))
            out.append([{"kind": KINDS[k], "start": s, "end": e, "found_by": by} for s, k, e, by in sorted(spans)])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("found_by", pa.string())]))
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(out, kind)], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, spans array<{SPAN}>")


def meets(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether one of the sorted spans shares a place with start:end; pattern spans of four kinds overlap at most so often."""
    low, high = 0, len(taken)
    while low < high:
        middle = (low + high) // 2
        low, high = (middle + 1, high) if taken[middle][0] < end else (low, middle)
    return any(e > start for _, e in taken[max(low - 8, 0) : low])


def redacted(docs: DataFrame, model: Field) -> DataFrame:
    """doc_id, text of every row with each span as its kind in brackets; of spans that overlap the first one counts."""
    found = docs.select(F.struct("doc_id", "text").alias("doc_id"), "text")
    spans = find(found, model).select("doc_id.doc_id", "doc_id.text", "spans")
    state = F.struct(F.lit("").alias("made"), F.lit(0).cast("long").alias("done"))

    def step(acc, s):
        piece = F.concat(acc["made"], F.substr("text", (acc["done"] + 1).cast("int"), (s["start"] - acc["done"]).cast("int")), F.lit("["), s["kind"], F.lit("]"))
        return F.when(s["start"] < acc["done"], acc).otherwise(F.struct(piece.alias("made"), s["end"].alias("done")))

    cut = F.aggregate("spans", state, step)
    rest = F.substr("text", (cut["done"] + 1).cast("int"), F.length("text"))
    return spans.select("doc_id", F.when(F.col("text").isNotNull(), F.concat(cut["made"], rest)).alias("text"))


def digests(docs: DataFrame, model: Field) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (all of the patterns) and spans (of both, as text)."""
    spelled = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    found = find(docs, model).withColumn("base", F.filter("spans", lambda s: s["found_by"] == "pattern"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(spelled(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        spelled(F.col("spans")).alias("spans"),
    )
