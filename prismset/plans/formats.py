"""Queries over annotation texts, written from the stand-in boxes and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismset.functions import boxes as B
from prismset.plans import standins as S
from prismset.plans.relational import _REASON
from prismset.session import table
from prismset.sources import annotations as A

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


_LINE = """CASE WHEN line_no = 3 AND part_id % 10 = 0 THEN 'x y z' WHEN line_no = 4 THEN {six} WHEN line_no = 5 THEN {zero} ELSE {five} END"""


def _lines(spark: SparkSession, d: str) -> DataFrame:
    five = "format_string('%d %.6f %.6f %.6f %.6f', class_id, x, y, w, h)"
    return S.boxes(spark, d).selectExpr("image_id", "line_no", "part_id", _LINE.format(five=five, six=f"concat({five}, ' 0.9')", zero=f"concat('0.0', substr({five}, 2))") + " AS line")


_FIVE = "printf('%d %.6f %.6f %.6f %.6f', class_id, x, y, w, h)"
_LINES_SQL = f"""{S.BOXES_SQL}, lines AS (SELECT image_id, line_no, part_id, {_LINE.format(five=_FIVE, six=f"{_FIVE} || ' 0.9'", zero=f"'0.0' || substr({_FIVE}, 2)")} AS line FROM boxes),
toks AS (SELECT *, string_split_regex(trim(line), ' +') AS t FROM lines),
nums AS (SELECT *, TRY_CAST(t[1] AS DOUBLE) AS c, TRY_CAST(t[2] AS DOUBLE) AS x, TRY_CAST(t[3] AS DOUBLE) AS y, TRY_CAST(t[4] AS DOUBLE) AS w, TRY_CAST(t[5] AS DOUBLE) AS h FROM toks)"""


@query(f"""WITH {_LINES_SQL}, p AS (SELECT *, CAST(c AS INT) AS class_id FROM nums WHERE len(t) = 5 AND c = floor(c) AND x IS NOT NULL AND y IS NOT NULL AND w IS NOT NULL AND h IS NOT NULL)
SELECT image_id, line_no, part_id, class_id, x, y, w, h FROM p WHERE {_REASON} = 'ok'""")
def yolo_parse_strict(spark: SparkSession, d: str) -> DataFrame:
    return A.yolo_strict(_lines(spark, d), "line", [0]).drop("line")


@query(f"""WITH {_LINES_SQL} SELECT image_id, line_no, part_id, printf('%d %.6f %.6f %.6f %.6f', CAST(trunc(c) AS INT), x, y, w, h) AS cleaned FROM nums
WHERE len(t) >= 5 AND c IS NOT NULL AND x BETWEEN 0 AND 1 AND y BETWEEN 0 AND 1 AND w BETWEEN 0 AND 1 AND h BETWEEN 0 AND 1""")
def yolo_clean_lenient(spark: SparkSession, d: str) -> DataFrame:
    return A.yolo_lenient(_lines(spark, d), "line").drop("line")


@query(f"""WITH {S.BOXES_SQL} SELECT image_id, string_agg({_FIVE}, chr(10) ORDER BY {_FIVE}) AS label, count(*) AS boxes FROM boxes GROUP BY image_id""")
def yolo_write(spark: SparkSession, d: str) -> DataFrame:
    """One label file for each image."""
    line = A.yolo_line(F.col("class_id"), *(F.col(c) for c in "xywh"))
    return S.boxes(spark, d).groupBy("image_id").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("label"), F.count("*").alias("boxes"))


_CORNER = {"x1": "l_partkey % 700", "y1": "l_linenumber * 10", "x2": "l_partkey % 700 + CAST(l_quantity AS INT)", "y2": "l_linenumber * 10 + l_partkey % 50"}
_CORNERS = ", ".join(f"{e} AS {k}" for k, e in _CORNER.items())


def _voc(spark: SparkSession, d: str) -> DataFrame:
    """An XML document for each order: unknown classes, missing sizes and broken ends among them."""
    rows = table(spark, d, "lineitem").selectExpr("l_orderkey AS image_id", "CASE WHEN l_orderkey % 13 = 0 AND l_linenumber = 1 THEN 'weed' ELSE 'grape' END AS name", *(f"CAST({e} AS INT) AS {k}" for k, e in _CORNER.items()))
    g = rows.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("name", "x1", "y1", "x2", "y2"))).alias("objects"))
    size = lambda n: F.when(F.col("image_id") % 5 == 0, 0).otherwise(n)
    xml = A.voc_xml(F.concat(F.lit("img_"), F.col("image_id").cast("string"), F.lit(".png")), size(800), size(600), F.col("objects"))
    return g.select("image_id", xml.alias("xml"))


@query(f"""WITH r AS (SELECT l_orderkey AS image_id, CASE WHEN l_orderkey % 13 = 0 AND l_linenumber = 1 THEN 1 ELSE 0 END AS unknown, {_CORNERS},
  CASE WHEN l_orderkey % 5 = 0 THEN 640.0::DOUBLE ELSE 800.0::DOUBLE END AS iw, CASE WHEN l_orderkey % 5 = 0 THEN 480.0::DOUBLE ELSE 600.0::DOUBLE END AS ih FROM lineitem),
b AS (SELECT *, (x1 + x2) / 2.0::DOUBLE / iw AS x, (y1 + y2) / 2.0::DOUBLE / ih AS y, (x2 - x1) / iw AS w, (y2 - y1) / ih AS h, 0 AS class_id, max(unknown) OVER (PARTITION BY image_id) AS bad FROM r),
v AS (SELECT *, bad = 0 AND w > 0 AND h > 0 AND {_REASON} = 'ok' AS ok FROM b)
SELECT image_id, max(bad) = 0 AS valid, CASE WHEN max(bad) = 1 THEN 'unknown class' END AS error, count(*) FILTER (ok) AS boxes, round(coalesce(sum(w) FILTER (ok), 0) + 0.0000000013, 6) AS width FROM v GROUP BY image_id""")
def voc_parse(spark: SparkSession, d: str) -> DataFrame:
    """VOC documents read back: boxes of each image, whole records failing on an unknown class."""
    p = A.voc_boxes(_voc(spark, d), "xml", {"grape": 0}, F.lit(640), F.lit(480))
    return p.select("image_id", "valid", "error", F.size("boxes").cast("long").alias("boxes"), F.round(F.aggregate("boxes", F.lit(0.0), lambda s, b: s + b["w"]) + 0.0000000013, 6).alias("width"))


@query(f"""WITH r AS (SELECT l_orderkey AS image_id, CASE WHEN l_orderkey % 13 = 0 AND l_linenumber = 1 THEN 'weed' ELSE 'grape' END AS name, {_CORNERS} FROM lineitem)
SELECT image_id, md5('<annotation><filename>img_' || image_id || '.png</filename><size><width>' || CASE WHEN image_id % 5 = 0 THEN 0 ELSE 800 END || '</width><height>' || CASE WHEN image_id % 5 = 0 THEN 0 ELSE 600 END || '</height></size>'
  || string_agg('<object><name>' || name || '</name><bndbox><xmin>' || x1 || '</xmin><ymin>' || y1 || '</ymin><xmax>' || x2 || '</xmax><ymax>' || y2 || '</ymax></bndbox></object>', '' ORDER BY name, x1, y1, x2, y2) || '</annotation>') AS xml_md5
FROM r GROUP BY image_id""")
def voc_write(spark: SparkSession, d: str) -> DataFrame:
    return _voc(spark, d).select("image_id", F.md5("xml").alias("xml_md5"))


_COCO_BOX = "[l_partkey % 700, l_linenumber * 10, l_quantity, l_partkey % 50]"


def _coco(spark: SparkSession, d: str) -> DataFrame:
    """JSON files of a hundred images each: (file, content)."""
    li = table(spark, d, "lineitem").withColumn("file", F.expr("l_orderkey div 100"))
    box = F.array(*(F.expr(f"CAST({e} AS DOUBLE)") for e in ("l_partkey % 700", "l_linenumber * 10", "l_quantity", "l_partkey % 50")))
    notes = li.groupBy("file").agg(
        F.collect_list(F.struct(F.col("l_orderkey").alias("image_id"), F.expr("CAST(l_linenumber % 4 AS BIGINT)").alias("category_id"), box.alias("bbox"))).alias("annotations"),
        F.collect_set(F.struct(F.col("l_orderkey").alias("id"), F.concat(F.lit("img_"), F.col("l_orderkey").cast("string"), F.lit(".png")).alias("file_name"), F.lit(800).alias("width"), F.lit(600).alias("height"))).alias("images"),
    )
    cats = F.array(*(F.struct(F.lit(k).cast("long").alias("id"), F.lit(n).alias("name")) for k, n in ((0, "grape"), (1, "leaf"), (2, "weed"))))
    return notes.select("file", F.to_json(F.struct("images", "annotations", cats.alias("categories"))).alias("content"))


@query(f"""WITH r AS (SELECT l_orderkey AS image_id, CASE l_linenumber % 4 WHEN 1 THEN 1 WHEN 2 THEN NULL ELSE 0 END AS class_id, {_COCO_BOX}::DOUBLE[] AS b FROM lineitem),
v AS (SELECT image_id, class_id, (b[1] + (b[1] + b[3])) / 2 / 800 AS x, (b[2] + (b[2] + b[4])) / 2 / 600 AS y, (b[1] + b[3] - b[1]) / 800 AS w, (b[2] + b[4] - b[2]) / 600 AS h FROM r WHERE b[3] > 0 AND b[4] > 0 AND class_id IS NOT NULL)
SELECT 'img_' || image_id || '.png' AS file_name, class_id, count(*) AS boxes, round(sum(w), 6) AS width FROM v WHERE {_REASON.replace('NOT IN (0)', 'NOT IN (0, 1)')} = 'ok' GROUP BY ALL""")
def coco_parse(spark: SparkSession, d: str) -> DataFrame:
    """COCO files read back; category 2 is no known class, 3 has no category and takes the first class."""
    return A.coco_boxes(_coco(spark, d), "file", "content", {"grape": 0, "leaf": 1}).groupBy("file_name", "class_id").agg(F.count("*").alias("boxes"), F.round(F.sum("w"), 6).alias("width"))


_FILES = """CASE CAST(substr(source, 4) AS INT) % 5 WHEN 0 THEN {0} WHEN 1 THEN {1} WHEN 2 THEN {2} WHEN 3 THEN {3} ELSE {4} END"""
_NAMES = _FILES.format(*(f"concat('f', doc_id, '{e}')" for e in (".json", ".xml", ".txt", ".txt", ".png")))
_TEXTS = _FILES.format("'{\"images\": [], \"annotations\": []}'", "'<annotation><object></object></annotation>'", "CASE WHEN doc_id % 3 = 0 THEN 'no label' ELSE '0 0.5 0.5 0.1 0.1' END", "'0 0.5 0.5 0.1'", "''")


@query("""WITH f AS (SELECT source AS subfolder, CAST(substr(source, 4) AS INT) % 5 AS k, doc_id, row_number() OVER (PARTITION BY source ORDER BY 'f' || doc_id || '.txt') AS n FROM documents)
SELECT subfolder, CASE max(k) WHEN 0 THEN 'coco_json' WHEN 1 THEN 'voc_xml' WHEN 2 THEN CASE WHEN 2 * count(*) FILTER (doc_id % 3 <> 0 AND n <= 20) > count(*) FILTER (n <= 20) THEN 'yolo_txt' ELSE 'custom' END
  WHEN 3 THEN 'custom' ELSE 'none' END AS fmt FROM f GROUP BY subfolder""")
def format_detection(spark: SparkSession, d: str) -> DataFrame:
    return A.detect(table(spark, d, "documents").selectExpr("source AS subfolder", f"{_NAMES} AS name", f"{_TEXTS} AS content"))


@query("""WITH b AS (SELECT event_id, value, (value - 5) * 40 AS x1, value * 3 AS y1, (value - 5) * 40 + event_id % 90 AS x2, value * 3 + event_id % 60 AS y2 FROM events WHERE value / 20 >= 0.5),
c AS (SELECT event_id, CAST(trunc(greatest(0.0::DOUBLE, least(x1, 799.0::DOUBLE))) AS INT) AS x1, CAST(trunc(greatest(0.0::DOUBLE, least(y1, 599.0::DOUBLE))) AS INT) AS y1,
  CAST(trunc(greatest(0.0::DOUBLE, least(x2, 799.0::DOUBLE))) AS INT) AS x2, CAST(trunc(greatest(0.0::DOUBLE, least(y2, 599.0::DOUBLE))) AS INT) AS y2 FROM b)
SELECT * FROM c WHERE x2 > x1 AND y2 > y1""")
def auto_label_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Predicted boxes over a confidence, clamped to the image, those without extent left out."""
    b = table(spark, d, "events").where(F.col("value") / 20 >= 0.5).selectExpr("event_id", "(value - 5) * 40 AS x1", "value * 3 AS y1", "(value - 5) * 40 + event_id % 90 AS x2", "value * 3 + event_id % 60 AS y2")
    c = B.clamp_corners(*(F.col(k) for k in ("x1", "y1", "x2", "y2")), F.lit(800), F.lit(600))
    return b.select("event_id", *(v.alias(k) for k, v in c.items())).where("x2 > x1 AND y2 > y1")
