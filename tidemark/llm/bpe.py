"""Byte-pair encoding and decoding with a given vocabulary file of the ``tokenizers`` layout.

A short word is held as one contiguous list of parts with the rank of every adjacent pair beside it:
the smallest rank is looked for again and again, its right part is deleted and the two ranks next to
it are renewed. A word of more than SHORT parts (one letter run of a very long text) does the same
merges in the same order from a heap over linked parts, so that its cost is not quadratic.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from tidemark.llm.batches import parts

SHORT = 128
#: Words whose ids a task remembers; when full it starts anew, which only costs time.
REMEMBERED = 200_000
NO_RANK = 1 << 60
#: Outside these ranges character tables of different Unicode versions differ, and the ones that
#: belong to the vocabulary's library decide on case, composition and classes.
UNUSUAL = regex.compile(r"[^\x00-\u0557\u2010-\u2027]")


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    own = {b for low, high in (("!", "~"), ("¡", "¬"), ("®", "ÿ")) for b in range(ord(low), ord(high) + 1)}
    free = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


def lowered(text: str) -> str:
    """Lower case character by character: a sigma at the end of a word is like any other."""
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


class Codec:
    """Encoder and decoder for a vocabulary with word ends and lower-cased, composed text."""

    def __init__(self, vocabulary: str) -> None:
        spec = json.loads(vocabulary)
        model = spec["model"]
        self.token_of = {i: t for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_of |= {i: t for t, i in self.special.items()}
        ids = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = [ids[x] for x in letters]
        self.last = [ids[x + suffix] for x in letters]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.cut_words = regex.compile(pattern)
        self.cut_unusual = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self.compose, self.lower = normalizers.NFC(), normalizers.Lowercase()
        self.known: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        if UNUSUAL.search(text):
            plain = self.lower.normalize_str(self.compose.normalize_str(text))
            return [word for word, _ in self.cut_unusual.pre_tokenize_str(plain)]
        return self.cut_words.findall(lowered(unicodedata.normalize("NFC", text)))

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode()
        part = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        return self.merge_short(part) if len(part) <= SHORT else self.merge_long(part)

    def merge_short(self, part: list[int]) -> list[int]:
        merges, none = self.merges, (NO_RANK, -1)
        adjacent = [merges.get(pair, none) for pair in zip(part, part[1:])]
        while adjacent:
            best = min(adjacent)
            if best is none or best[0] == NO_RANK:
                break
            at = adjacent.index(best)
            part[at] = best[1]
            del part[at + 1]
            del adjacent[at]
            if at < len(adjacent):
                adjacent[at] = merges.get((part[at], part[at + 1]), none)
            if at:
                adjacent[at - 1] = merges.get((part[at - 1], part[at]), none)
        return part

    def merge_long(self, part: list[int]) -> list[int]:
        merges, n = self.merges, len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(merges[p][0], i, *p) for i, p in enumerate(zip(part, part[1:])) if p in merges]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if part[i] != left or j >= n or part[j] != right:
                continue
            part[i], part[j] = merges[left, right][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (pair := (part[a], part[b])) in merges:
                    heapq.heappush(heap, (merges[pair][0], a, *pair))
        return [x for x in part if x >= 0]

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        out = []
        for piece in self.cut_special.split(text) if self.cut_special else [text]:
            if piece in self.special:
                out.append(np.uint32(self.special[piece]).astype("<u4").tobytes())
                continue
            for word in self.words(piece):
                ids = self.known.get(word)
                if ids is None:
                    if len(self.known) >= REMEMBERED:
                        self.known.clear()
                    ids = np.array(self.encode_word(word), "<u4").tobytes()
                    if len(word) <= SHORT:
                        self.known[word] = ids
                out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Tokens of the ids with a space between them, as a vocabulary without a decoder has it."""
        return " ".join(map(self.token_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def with_codec(df: DataFrame, vocabulary_path: str, column: str, method: str, name: str, kind: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    arrow = {"string": pa.string(), "binary": pa.binary()}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = getattr(Codec(shared.value), method)
        for part in parts(batches):
            at = part.schema.get_field_index(column)
            made = pa.array([work(x.as_py()) for x in part.column(at)], arrow)
            kept = [i for i in range(part.num_columns) if part.schema.names[i] != name]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(i) for i in kept), made], [*(part.schema.names[i] for i in kept), name]
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != name]
    return df.mapInArrow(run, ", ".join([*fields, f"`{name}` {kind}"]))


def encode(docs: DataFrame, vocabulary_path: str, column: str = "text", ids: str = "ids") -> DataFrame:
    """Every row with the ids of its whole ``column`` in ``ids`` (binary, little-endian unsigned 32-bit).

    The vocabulary (a fixed file, read where the driver runs) is broadcast. NULL and empty texts give
    empty ids; a column that is already called ``ids`` is replaced; rows are kept as often as they occur.
    No shuffle.
    """
    return with_codec(docs, vocabulary_path, column, "encode", ids, "binary")


def decode(encoded: DataFrame, vocabulary_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Every row with the decoded text of ``ids``; NULL ids give an empty text."""
    return with_codec(encoded.withColumn(ids, F.coalesce(ids, F.lit(b""))), vocabulary_path, ids, "decode", text, "string")


def digests(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Encode, decode again, and reduce both to counts and hashes in the same pass over a text."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for part in parts(batches):
            rows = []
            for text in part.column(1):
                ids = codec.encode(text.as_py())
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids).encode()).hexdigest()))
            n, a, b = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
