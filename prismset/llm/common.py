"""Helpers shared by the llm operators."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, as bytes: space and 0x09 to 0x0D.
SPACE = b" \t\n\x0b\x0c\r"
#: The same class as a regular expression.
SPACE_RE = r"[\x20\x09-\x0D]"
WORD_RE = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share for written intermediate tables.

    It is the one named by ``spark.checkpoint.dir``. A local session (tests, a
    laptop) that names none gets a temporary folder of its machine; on a cluster
    that would lose files, so there it is an error.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isEmpty():
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="prismset-"))
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
    return held.get().rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage at files that survive the loss of any executor. The
    path is kept on the frame as ``stored_at`` for ``discard``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/prismset-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete a materialized table that no later plan reads."""
    path = getattr(df, "stored_at", None)
    if path:
        sc = df.sparkSession.sparkContext
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def row_key(df: DataFrame) -> Column:
    """A 64-bit name of a row's whole content; rows that agree in all columns share it."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def id_hash(doc_id: Column) -> Column:
    """CRC32 of the id written as text, as the fold rules use it."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task; what making them took goes back to the system afterwards.

    Workers live on between tasks, and without this each would keep the most
    memory that any of its tasks has used.
    """
    yield from batches
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def worker_cache(key: object, make: Callable[[], object]) -> object:
    """A value made once in each Python worker, kept between its tasks."""
    held = sys.modules.setdefault("_prismset_worker_cache", types.ModuleType("_prismset_worker_cache")).__dict__
    if key not in held:
        for old in [k for k in held if isinstance(k, tuple) and isinstance(key, tuple) and k[0] == key[0]]:
            del held[old]
        held[key] = make()
    return held[key]
