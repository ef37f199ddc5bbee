"""WARC archives: pages as chunk rows, written record by record and read back, payloads never whole in Python.

1. Payload digests and lengths are expressions; the first page of each digest is a map-side aggregate.
2. The payloads to be stored become rows (record, chunk number, bytes) of at most CHUNK bytes. A writer per
   partition streams them into gzip members, and begins another archive when one is full.
3. A reader per archive streams the members and carries SHA-1 from chunk to chunk.

Archives go to the shared folder. A writer fills a file of its own attempt and moves it into place at
the end, so a task that is run again replaces what a lost executor left.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import materialise, scratch_uri

CHUNK = 1 << 20
#: Bytes after which a writer begins another archive.
ARCHIVE = 1 << 30
SALTS = 32
URN = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_of_hex(digest: Column) -> Column:
    """RFC 4648 base32 of 40 hex digits: each group of five hex digits is four letters."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    groups = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda g: F.conv(F.substring(digest, g * 5 + 1, F.lit(5)), 16, 10).cast("int"))
    spelled = F.transform(
        groups,
        lambda v: F.concat(
            *(F.substring(letters, F.shiftright(v, 5 * k).bitwiseAND(31) + 1, F.lit(1)) for k in (3, 2, 1, 0))
        ),
    )
    return F.array_join(spelled, "")


def planned(pages: DataFrame, at_least: int = 0) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    Of payloads that are equal and have ``at_least`` bytes the least ``page_id`` is the response; rows that
    repeat it are responses too. A NULL ``page_id`` revisits, unless a payload has no other. A payload
    of very many pages is met in ``SALTS`` parts.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    digested = pages.select(
        "page_id", "url", payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("hex"),
    )
    slim = digested.where(F.col("payload_bytes") >= at_least).select("page_id", "hex", "payload_bytes")
    # Most payloads occur once and need no partner; only the others are written to all salts.
    first = slim.groupBy("hex", "payload_bytes").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1").drop("n")
    salted = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = digested.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")).join(
        salted, ["hex", "payload_bytes", "salt"], "left"
    )
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return met.select(
        "page_id", "url", "payload", "payload_bytes", base32_of_hex(F.col("hex")).alias("payload_digest"),
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("first")).alias("refers_to"),
    )


def chunk_rows(plan: DataFrame) -> DataFrame:
    """A row per record and chunk: the record's columns, chunk number and bytes; a revisit has one empty chunk.

    The chunks of a record follow each other in one partition, number 0 first. Rows are made for the numbers before
    bytes are cut, so that beside the payload itself only one chunk is held.
    """
    stored = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    count = F.greatest(F.ceil(F.octet_length(stored) / F.lit(CHUNK)), F.lit(1)).cast("int")
    numbered = plan.withColumn("stored", stored).withColumn("chunk", F.explode(F.sequence(F.lit(0), count - 1)))
    return numbered.select(
        "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "chunk",
        F.substring("stored", F.col("chunk") * CHUNK + 1, F.lit(CHUNK)).alias("bytes"),
    )


def header(row: dict, block_bytes: int) -> bytes:
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <{URN}{'' if row['page_id'] is None else row['page_id']}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {' '.join((row['url'] or '').split())}",
        f"WARC-Payload-Digest: sha1:{row['payload_digest']}",
        f"WARC-Payload-Length: {row['payload_bytes']}",
    ]
    if row["record_type"] == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{URN}{row['refers_to']}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {block_bytes}"]
    return "\r\n".join([*lines, "", ""]).encode()


def http_head(row: dict) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()


class Writer:
    """One archive after the other: a new one is begun before a record if the open one has ``most`` bytes."""

    def __init__(self, folder: str, most: int) -> None:
        self.store, self.base = arrow_fs.FileSystem.from_uri(folder)
        self.store.create_dir(self.base, recursive=True)
        self.most, self.out, self.packer, self.done = most, None, None, []

    def put(self, packed: bytes) -> None:
        self.out.write(packed)
        self.written += len(packed)

    def begin(self, head: bytes) -> None:
        self.end_record()
        if self.out is not None and self.written >= self.most:
            self.close()
        if self.out is None:
            self.name, self.written, self.records = uuid.uuid4().hex, 0, 0
            self.out = self.store.open_output_stream(f"{self.base}/{self.name}.open", compression=None)
        self.packer, self.records = zlib.compressobj(1, zlib.DEFLATED, 31), self.records + 1
        self.add(head)

    def add(self, part: bytes) -> None:
        self.put(self.packer.compress(part))

    def end_record(self) -> None:
        if self.packer:
            self.put(self.packer.compress(b"\r\n\r\n") + self.packer.flush())
            self.packer = None

    def close(self) -> None:
        self.end_record()
        if self.out is not None:
            self.out.close()
            self.store.move(f"{self.base}/{self.name}.open", f"{self.base}/{self.name}.warc.gz")
            self.done.append((f"{self.name}.warc.gz", self.records))
            self.out = None


def write_archives(chunks: DataFrame, folder: str, most: int = ARCHIVE) -> DataFrame:
    """(path, records) of the archives below ``folder``. A partition that has rows fills archives of ``most`` bytes, each
    more by its last record at most.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = Writer(folder, most)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["chunk"] == 0:
                    head = http_head(row)
                    block = len(head) + (row["payload_bytes"] if row["record_type"] == "response" else 0)
                    writer.begin(header(row, block) + head)
                writer.add(row["bytes"])
        writer.close()
        if writer.done:
            paths, records = zip(*writer.done)
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(records, pa.int64())], ["path", "records"])

    return chunks.mapInArrow(write, "path string, records long")


class Reader:
    """Records of one gzip archive from a stream, held one chunk at a time."""

    def __init__(self, stream) -> None:
        self.stream, self.packed, self.plain = stream, b"", bytearray()
        self.unpacker = zlib.decompressobj(31)

    def more(self) -> bool:
        """Unpack at most CHUNK bytes more; False at the end."""
        while True:
            if self.unpacker.eof:
                self.packed = self.unpacker.unused_data
                self.unpacker = zlib.decompressobj(31)
            if not self.packed:
                self.packed = self.stream.read(CHUNK)
                if not self.packed:
                    return False
            got = self.unpacker.decompress(self.packed, CHUNK)
            self.packed = self.unpacker.unconsumed_tail
            if got:
                self.plain += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (at := self.plain.find(mark, start)) < 0:
            start = max(0, len(self.plain) - len(mark) + 1)
            if not self.more():
                return None
        found = bytes(self.plain[:at])
        del self.plain[: at + len(mark)]
        return found

    def take(self, count: int) -> Iterator[bytes]:
        while count:
            if not self.plain and not self.more():
                raise ValueError("archive ends inside a record")
            got = bytes(self.plain[:count])
            del self.plain[: len(got)]
            count -= len(got)
            yield got

    def records(self) -> Iterator[tuple]:
        """(page_id, payload_bytes, payload_digest, record_type, refers_to); the payload is digested on the way."""
        while (raw := self.until(b"\r\n\r\n")) is not None:
            fields = dict(line.split(": ", 1) for line in raw.decode().split("\r\n")[1:])
            kind, size = fields["WARC-Type"], int(fields["Content-Length"])
            head = self.until(b"\r\n\r\n")
            length, digest = 0, hashlib.sha1()
            for got in self.take(size - len(head) - 4):
                length += len(got)
                digest.update(got)
            if b"".join(self.take(4)) != b"\r\n\r\n":
                raise ValueError("record is longer than it says")
            named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
            if kind == "response" and base64.b32encode(digest.digest()).decode() != named:
                raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
            if kind == "revisit":
                length = int(fields["WARC-Payload-Length"])
            own, other = (
                fields[x][len(URN) + 1 : -1] if x in fields else "" for x in ("WARC-Record-ID", "WARC-Refers-To")
            )
            yield int(own) if own else None, length, named, kind, int(other) if other else None


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """The records of ``archives(path)`` below ``folder``, one row each."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = arrow_fs.FileSystem.from_uri(folder)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held = []
                with store.open_input_stream(f"{base}/{path}", compression=None) as stream:
                    for record in Reader(stream).records():
                        held.append(record)
                        if len(held) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held), kinds)], names)
                            held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held), kinds)], names)

    return archives.select("path").mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def round_trip(pages: DataFrame, at_least: int = 0, most: int = ARCHIVE) -> DataFrame:
    """Write a record per row of ``pages(page_id, url, html)``, read the archives, return a row per record.

    NULL and empty html is an empty payload; NULL urls are empty; further columns are left out. An
    empty table gives no archive and no row.
    """
    spark = pages.sparkSession
    folder = scratch_uri(spark, "archives")
    written = materialise(write_archives(chunk_rows(planned(pages, at_least)), folder, most), "manifest")
    return read_archives(written.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))), folder)
