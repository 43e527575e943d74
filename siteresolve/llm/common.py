"""What the training-data operators share: input tables, durable intermediate tables, files on shared storage."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dirs: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; one of our own only where that is unset and all runs in one process, as in tests."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if given:
        return given.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="spark-")
    return _own_dirs[app]


def new_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def durable(df: DataFrame, name: str, **options: object) -> DataFrame:
    """Write ``df`` to the shared folder, with the Parquet writer's ``options``, and read it back: cuts lineage, survives lost executors."""
    path = new_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_BYTES = 32 << 20


def size_checked(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` marked for a broadcast join if its counted rows, of ``row_bytes`` each, fit in BROADCAST_BYTES; else as it is, for a shuffled one."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``; after each, freed memory that Arrow and the C library keep goes back to the system, since workers stay alive for the stages that follow."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()
        if trim:
            trim(0)


def open_fs(uri: str):
    """pyarrow file system and the path in it, for a URI or a plain local path."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


def utf8_bytes(text):
    """Length in UTF-8 of a string column."""
    return F.octet_length(text).cast("long")
