"""Session settings and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Sessions of a hot key are merged in each input task before the shuffle.
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session that names none gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="spark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared root, removed when the application ends."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a whole URI: one without a scheme is in the default file system, as Spark itself takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    scheme, _, rest = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString().partition(":")
    # Hadoop writes file:/x where others want file:///x.
    return f"{scheme}:{rest}" if rest.startswith("//") else f"{scheme}://{rest}"


def scratch_uri(spark: SparkSession, label: str) -> str:
    """A scratch path as a URI, for code in tasks that opens files itself."""
    return qualified(spark, scratch_path(spark, label))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per Spark context.

    Needed where it is not installed on the executors (``--py-files`` does the same).
    """
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='tidemark-')}/tidemark", "zip", package.parent, package.name
    )
    context.addPyFile(archive)
    context._tidemark_shipped = True


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a result used several times to the shared folder and read it back.

    Unlike a cache it outlives lost executors, and later branches start from it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def even_out(df: DataFrame, *keys: str) -> DataFrame:
    """Narrow rows over all shuffle partitions, in front of a step that costs much per row."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(width, *keys)
