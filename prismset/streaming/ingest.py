"""Incremental ingestion: new label files are validated as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from prismset.functions import boxes as B
from prismset.sources import annotations as A


def label_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the text files of a folder, as a stream with their file."""
    return spark.readStream.format("text").load(folder).select(F.input_file_name().alias("file"), F.col("value").alias("line"))


def validated(lines: DataFrame, allowed: list[int]) -> DataFrame:
    """Every line with its boxes' numbers and the first reason against it (null: valid)."""
    t = A.tokens(F.col("line"))
    v = [A.number(F.get(t, k)) for k in range(5)]
    bad = (F.size(t) != 5) | v[0].isNull() | (v[0] != F.floor(v[0])) | v[1].isNull() | v[2].isNull() | v[3].isNull() | v[4].isNull()
    return lines.withColumn("reason", F.when(bad, "malformed").otherwise(B.reason(v[0].cast("int"), *v[1:], allowed)))


def start(spark: SparkSession, folder: str, out: str, checkpoint: str, allowed: list[int]) -> StreamingQuery:
    """Append validated lines to Parquet, each file once, until nothing is left to read."""
    return validated(label_stream(spark, folder), allowed).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
