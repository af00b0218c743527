"""The driver's tables seen as an image dataset (the tables hold no images)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismset.session import table

WIDTH, HEIGHT, TARGET = 800, 600, 640


def image_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, path): a file name for each document."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        F.expr("""concat('data/', source, CASE WHEN doc_id % 3 = 0 THEN '/RGB-D/' ELSE '/plain/' END,
            element_at(array('HorFlip_', 'VertFlip_', 'topwarp_', 'BottomWarp_', 'leftwarp_', 'rightomwarp_', 'rightwarp_', '', ''), CAST(doc_id % 9 + 1 AS INT)),
            'IMG_', doc_id, CASE WHEN doc_id % 2 = 0 THEN '_Color' ELSE '' END, '.',
            element_at(array('png', 'JPG', 'jpeg', 'bmp', 'tif', 'webp', 'txt', 'xml'), CAST(doc_id % 8 + 1 AS INT)))""").alias("path"),
    )


IMAGE_PATHS_SQL = """
image_paths AS (
  SELECT doc_id, source, 'data/' || source || CASE WHEN doc_id % 3 = 0 THEN '/RGB-D/' ELSE '/plain/' END
    || (['HorFlip_', 'VertFlip_', 'topwarp_', 'BottomWarp_', 'leftwarp_', 'rightomwarp_', 'rightwarp_', '', ''])[doc_id % 9 + 1]
    || 'IMG_' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '_Color' ELSE '' END || '.'
    || (['png', 'JPG', 'jpeg', 'bmp', 'tif', 'webp', 'txt', 'xml'])[doc_id % 8 + 1] AS path FROM documents)"""


def boxes(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """(image_id, part_id, line_no, class_id, x, y, w, h): a box for each line item.

    ``wide`` takes the projection whose boxes also fail on centre and extent.
    """
    x, y, w, h = ("l_discount * 12 - 0.1", "l_tax * 15 - 0.1", "(l_quantity - 2) / 45", "(l_partkey % 50) / 45.0D") if wide else ("l_discount * 10 + 0.0", "l_tax * 12.5 + 0.0", "l_quantity / 100", "(l_partkey % 50 + 1) / 100.0D")
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS image_id", "l_partkey AS part_id", "l_linenumber AS line_no", "CASE WHEN l_linenumber > 6 THEN 9 ELSE 0 END AS class_id", *(f"CAST({e} AS DOUBLE) AS {k}" for k, e in zip("xywh", (x, y, w, h), strict=True))
    )


BOXES_SQL = """
boxes AS (
  SELECT l_orderkey AS image_id, l_partkey AS part_id, l_linenumber AS line_no, CASE WHEN l_linenumber > 6 THEN 9 ELSE 0 END AS class_id,
    l_discount * 10::DOUBLE + 0.0::DOUBLE AS x, l_tax * 12.5::DOUBLE + 0.0::DOUBLE AS y, l_quantity / 100::DOUBLE AS w, (l_partkey % 50 + 1) / 100.0::DOUBLE AS h FROM lineitem)"""
WIDE_SQL = """
boxes AS (
  SELECT l_orderkey AS image_id, l_partkey AS part_id, l_linenumber AS line_no, CASE WHEN l_linenumber > 6 THEN 9 ELSE 0 END AS class_id,
    l_discount * 12::DOUBLE - 0.1::DOUBLE AS x, l_tax * 15::DOUBLE - 0.1::DOUBLE AS y, (l_quantity - 2) / 45::DOUBLE AS w, (l_partkey % 50) / 45.0::DOUBLE AS h FROM lineitem)"""


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(i, lo, hi): a 64-bit hash of each document; five in a row share one, of which each flips some bits."""
    word = lambda seed, key: f"CAST(conv(substr(md5(concat('{seed}|', {key})), 1, 8), 16, 10) AS BIGINT)"
    flips = "(" + " & ".join(word(f"f{k}", "doc_id") for k in range(3)) + ")"
    return table(spark, sf_dir, "documents").selectExpr("doc_id AS i", f"{word('lo', 'doc_id div 5')} ^ IF(doc_id % 5 < 2, 0L, {flips}) AS lo", f"{word('hi', 'doc_id div 5')} AS hi")


def _word(seed: str, key: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}|' || {key}), 1, 8) AS BIGINT)"


#: Pairs (i, j, d) with i < j and at most {t} differing bits.
PAIRS_SQL = f"""
v AS (
  SELECT doc_id AS i, xor({_word('lo', 'doc_id // 5')}, CASE WHEN doc_id % 5 < 2 THEN 0::BIGINT ELSE {' & '.join(_word(f'f{k}', 'doc_id') for k in range(3))} END) AS lo,
    {_word('hi', 'doc_id // 5')} AS hi FROM documents),
pairs AS (
  SELECT p.i, q.i AS j, CAST(bit_count(xor(p.lo, q.lo)) + bit_count(xor(p.hi, q.hi)) AS INT) AS d
  FROM v p JOIN v q ON p.i < q.i AND bit_count(xor(p.lo, q.lo)) + bit_count(xor(p.hi, q.hi)) <= {{t}})"""
