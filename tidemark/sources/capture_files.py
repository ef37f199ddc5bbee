"""Saved pages of a date put together: the national page, the foreign one and their labels as one row."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import datetime
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import fixed, gates
from tidemark.session import even_out, qualified
from tidemark.sources import captures

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
#: What is known of a file before it is read.
LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint"
#: A task hands on files once it has read that much.
BYTES_PER_BATCH = 8 << 20
#: ``<anything>_ddmmyyyy`` for the national page of a date, with ``_me`` behind it for the foreign one.
FILE_NAME = r"_(\d{8})(_me)?\.[A-Za-z]+$"
LABEL = rf"""(?is)\bid\s*=\s*["']?{fixed.LABEL_ID}["']?[^>]*>(.*?)</"""


def label_of(html: Column) -> Column:
    """Text of the page's label without inner tags; NULL where the page has none."""
    found = F.regexp_extract_all(html, F.lit(LABEL), F.lit(1))
    return F.trim(F.regexp_replace(F.try_element_at(found, F.lit(1)), "<[^>]*>", ""))


def pages_of(files: DataFrame) -> DataFrame:
    """``path, requested_date, lado, llegada, label_text, html, usable`` of every file, batch or stream.

    ``usable``: named by a date, and in force for it; a foreign page has to confirm both currency and date.
    """
    name = F.col("path")
    day = F.try_to_date(F.regexp_extract(name, FILE_NAME, 1), "ddMMyyyy")
    foreign = F.regexp_extract(name, FILE_NAME, 2) != ""
    read = files.select(
        "path", F.when(F.regexp_extract(name, FILE_NAME, 1) != "", day).alias("requested_date"),
        F.when(foreign, fixed.FOREIGN).otherwise(fixed.NATIONAL).alias("lado"),
        F.col("modificationTime").alias("llegada"), captures.page_text(F.col("content")).alias("html"),
    ).withColumn("label_text", label_of(F.col("html")))
    ok = F.when(
        F.col("lado") == fixed.FOREIGN, gates.foreign_confirmed(F.col("label_text"), F.col("requested_date"))
    ).otherwise(gates.in_force(F.col("label_text"), F.col("requested_date")))
    return read.withColumn("usable", F.coalesce(ok & F.col("requested_date").isNotNull(), F.lit(False)))


def _listing_row(root: str, base: str, info: fs.FileInfo) -> tuple[str, datetime, int]:
    # Whole milliseconds, as Spark's own file source gives them.
    when = info.mtime.replace(microsecond=info.mtime.microsecond // 1000 * 1000)
    return root + info.path[len(base):], when, info.size


def _listing_batch(rows: list[tuple[str, datetime, int]]) -> pa.RecordBatch:
    path, when, size = zip(*rows) if rows else ((), (), ())
    columns = [pa.array(path, pa.string()), pa.array(when, pa.timestamp("us", "UTC")), pa.array(size, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["path", "modificationTime", "length"])


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path, modificationTime, length`` of all files below a folder whose name fits; hidden ones are left out.

    Folders are listed inside tasks, one row each: first the folder itself, then what its folders hold at any depth.
    Neither the driver nor a plan ever has the list.
    """

    def shown(place: str) -> bool:
        return not any(part.startswith((".", "_")) for part in place.split("/") if part)

    def found(batches: Iterator[pa.RecordBatch], deep: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for root, size in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if size is not None:
                    yield _listing_batch([]) if deep else batch
                    continue
                store, base = fs.FileSystem.from_uri(root)
                rows = []
                for info in store.get_file_info(fs.FileSelector(base, recursive=deep)):
                    if not shown(info.path[len(base):]):
                        continue
                    if info.is_file and fnmatchcase(info.base_name, pattern):
                        rows.append(_listing_row(root, base, info))
                    elif not deep and not info.is_file:
                        rows.append((root + info.path[len(base):], None, None))
                yield _listing_batch(rows)

    root = qualified(spark, path).rstrip("/")
    start = spark.createDataFrame([(root, None, None)], LISTING_SCHEMA).coalesce(1)
    top = start.mapInArrow(lambda b: found(b, False), LISTING_SCHEMA)
    inner = even_out(top.filter("length IS NULL"), "path").mapInArrow(lambda b: found(b, True), LISTING_SCHEMA)
    return top.filter("length IS NOT NULL").unionByName(inner)


def with_content(listing: DataFrame) -> DataFrame:
    """Listed files, batch or stream, with their ``content``: opened where they are processed, a batch of them at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            since, held, contents = 0, 0, []
            for at, path in enumerate(batch.column(0).to_pylist()):
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_stream(place) as source:
                    contents.append(source.read())
                held += len(contents[-1])
                if held >= BYTES_PER_BATCH or at + 1 == batch.num_rows:
                    part = batch.slice(since, len(contents))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(contents, pa.binary())], [*part.schema.names, "content"])
                    since, held, contents = at + 1, 0, []

    return even_out(listing.select("path", "modificationTime", "length"), "path").mapInArrow(read, FILE_SCHEMA)


def read_pages(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """All saved pages below a folder, as ``pages_of`` gives them. Listed and read inside tasks."""
    return pages_of(with_content(list_files(spark, path, pattern)))


def assembled(pages: DataFrame) -> DataFrame:
    """One row per date with a usable national page: the last one to arrive, and the last usable foreign page.

    ``requested_date, llegada, label_text, html, label_foreign, html_foreign``, as ``captures.deposit_rates``
    takes them. ``llegada`` is that of the later page. Of pages that arrived at one time that with the greater path
    counts. A stale or unconfirmed page never hides a usable one. The last page of each side is an aggregate that is
    combined in every input task, so many attempts for a date are no hot group.
    """
    order = F.struct("llegada", "path")

    def last(side: str) -> Column:
        return F.max_by(F.struct("llegada", "label_text", "html"), F.when(F.col("lado") == side, order))

    sides = pages.filter("usable").groupBy("requested_date").agg(
        last(fixed.NATIONAL).alias("n"), last(fixed.FOREIGN).alias("e")
    )
    return sides.filter(F.col("n").isNotNull()).select(
        "requested_date", F.greatest("n.llegada", "e.llegada").alias("llegada"), F.col("n.label_text").alias("label_text"),
        F.col("n.html").alias("html"), F.col("e.label_text").alias("label_foreign"), F.col("e.html").alias("html_foreign"),
    )


def general_rates(assembled_pages: DataFrame) -> DataFrame:
    """Long general rates of assembled dates with the ``llegada`` of their date."""
    return captures.deposit_rates(assembled_pages, keep=("llegada",))[0]


def write_files(files: DataFrame, folder: str, notices: str | None = None) -> int:
    """Write ``archivo, content`` as files below ``folder``; gives their number. A name may have folders in it.

    Every task writes its own rows. A file gets its name when it is whole, so a reader never meets half of one, and a
    task that is run again writes the same files again. With ``notices`` each task also leaves a list there of the files it
    wrote, as ``list_files`` gives them, once they are whole; a stream takes those up instead of listing the folder.
    """
    root = qualified(files.sparkSession, folder).rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        made = set()
        for batch in batches:
            places = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                inside, _, own = f"{base}/{name}".rpartition("/")
                if inside not in made:
                    store.create_dir(inside)
                    made.add(inside)
                draft = f"{inside}/.{own}.{uuid.uuid4().hex}"
                with store.open_output_stream(draft) as out:
                    out.write(content.as_buffer())
                store.move(draft, f"{inside}/{own}")
                places.append(f"{inside}/{own}")
            yield _listing_batch([_listing_row(root, base, info) for info in store.get_file_info(places)])

    named = files.filter("archivo IS NOT NULL AND content IS NOT NULL")
    done = named.select("archivo", F.col("content").cast("binary")).mapInArrow(write, LISTING_SCHEMA)
    if notices is None:
        return done.count()
    seen = Observation()
    done.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(notices)
    return seen.get["n"]


def page_facts(pages: DataFrame, rates: DataFrame) -> DataFrame:
    """Facts for the ledger (``fecha, fallo, vigente_al, filas``) of every date that has a page.

    A date is stale if it has no usable national page; it is then in force for the latest date its pages name.
    """
    national = pages.filter((F.col("lado") == fixed.NATIONAL) & F.col("requested_date").isNotNull())
    seen = national.groupBy(F.col("requested_date").alias("fecha")).agg(
        F.max("usable").alias("_vale"),
        F.max(F.try_to_date(gates.effective_date(F.col("label_text")), "dd/MM/yyyy")).alias("_dia"),
    )
    counted = rates.groupBy("fecha").agg(F.count(F.lit(1)).alias("filas"))
    return seen.join(counted, "fecha", "left").select(
        "fecha", F.lit(False).alias("fallo"),
        F.when(~F.col("_vale"), F.date_format("_dia", "dd/MM/yyyy")).alias("vigente_al"),
        F.coalesce("filas", F.lit(0)).cast("bigint").alias("filas"),
    )
