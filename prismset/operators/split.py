"""Train/validation/test splits without leakage between related records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def seeded(key: Column, seed: int) -> Column:
    """A reproducible shuffle key that does not depend on the partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def _cut(place: Column, n: Column, train: float, val: float, half_even: bool) -> Column:
    take = (lambda r: F.bround(n * r)) if half_even else (lambda r: F.floor(n * r))
    return F.when(place <= take(train), "train").when(place <= take(train) + take(val), "val").otherwise("test")


def group_split(groups: DataFrame, strata: str, key: str, train: float = 0.7, val: float = 0.15, seed: int = 42) -> DataFrame:
    """``groups`` (one row a group) with ``split``, stratified; counts round half-even."""
    w = W.partitionBy(strata)
    order = w.orderBy(seeded(F.col(key), seed), key)
    return groups.withColumn("split", _cut(F.row_number().over(order), F.count("*").over(w), train, val, True))


def flat_split(df: DataFrame, key: str, train: float = 0.7, val: float = 0.15, seed: int = 42) -> DataFrame:
    """``df`` with ``split`` over all rows; counts are cut down to whole numbers.

    Places come from two levels: rows are counted by the first digits of their
    shuffle key, then ranked among those with the same digits, so that no task
    sorts all rows.
    """
    keyed = df.withColumn("_k", seeded(F.col(key), seed)).withColumn("_p", F.substring("_k", 1, 3))
    sizes = keyed.groupBy("_p").agg(F.count("*").alias("_n"))  # 4096 rows at most
    before = W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at"), F.sum("_n").over(W.partitionBy()).alias("_all"))
    placed = keyed.join(F.broadcast(sizes), "_p").withColumn("_i", F.col("_at") + F.row_number().over(W.partitionBy("_p").orderBy("_k", key)))
    return placed.withColumn("split", _cut(F.col("_i"), F.col("_all"), train, val, False)).drop("_k", "_p", "_at", "_all", "_i")
