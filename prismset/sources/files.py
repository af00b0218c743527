"""Files of a dataset: paths as Spark names them, input folders, bytes written where executors and driver meet."""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def plain(path: str | Column) -> Column:
    """A local path without scheme and escapes; other addresses as they are."""
    return F.regexp_replace(F.url_decode(F.replace(F.col(path) if isinstance(path, str) else path, F.lit("+"), F.lit("%2B"))), "^file:/+", "/")


def pattern(extensions: list[str]) -> str:
    """A glob for files of these extensions in either case."""
    return "*.{" + ",".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in e) for e in extensions) + "}"


def contents(spark: SparkSession, root: str, extensions: list[str], deep: bool = True) -> DataFrame:
    """(path, content) of the files of these extensions below ``root``, or right in it.

    Spark's reader passes over empty files; they are added from the list of files
    that it holds anyway.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern(extensions)).option("recursiveFileLookup", str(deep).lower()).load(root)
    read = found.select(plain("path").alias("path"), "content")
    listed = spark.createDataFrame([(f,) for f in found.inputFiles()], "path string").select(plain("path").alias("path"))
    empty = listed.join(read.select("path"), "path", "left_anti")
    return read.unionByName(empty.withColumn("content", F.lit(b"")))


def input_folder(named: str) -> str:
    """The first that exists of: the folder as named, beside the working folder's parent, below the working folder.

    Addresses with a scheme are left to Spark.
    """
    if "://" in named:
        return named.rstrip("/")
    tried = [Path(named), Path("..") / named, Path.cwd() / named]
    found = next((p for p in tried if p.exists()), None)
    if found is None:
        raise FileNotFoundError(f"there is no input folder {named}")
    return found.resolve().as_posix()


def put(base: str, name: str, body: bytes, replace: bool = True) -> None:
    """Write a file below ``base``, a folder or address that driver and executors share."""
    store, where = pyarrow.fs.FileSystem.from_uri(base) if "://" in base else (pyarrow.fs.LocalFileSystem(), base)
    at = posixpath.join(where, name)
    if not replace and store.get_file_info(at).type != pyarrow.fs.FileType.NotFound:
        return
    store.create_dir(posixpath.dirname(at), recursive=True)
    with store.open_output_stream(at) as f:
        f.write(body)


def each(df: DataFrame, write: Callable[[tuple], tuple], schema: str) -> DataFrame:
    """One row of ``write``'s results for each row of ``df``."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([write(r) for r in b.itertuples(index=False)], columns=names)

    return df.mapInPandas(run, schema)


def data_yaml(folder: str, classes: dict[int, str]) -> bytes:
    """The description of a dataset in YOLO layout."""
    names = "".join(f"  {k}: {v}\n" for k, v in sorted(classes.items()))
    return f"path: {folder}\ntrain: train/images\nval: val/images\ntest: test/images\nnames:\n{names}".encode()
