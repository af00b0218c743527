"""Queries over paths, joins, duplicates, splits, statistics and integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from prismset.functions import boxes as B
from prismset.functions import paths as P
from prismset.operators import dedup, split
from prismset.plans import standins as S
from prismset.session import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def long(c) -> F.Column:
    return F.coalesce(c, F.lit(0)).cast("long")


def docs_labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")


# --- ingestion -----------------------------------------------------------------


@query("""
SELECT coalesce(source, '(all)') AS source, count(*) AS total, count(*) FILTER (quality = 1) AS valid, count(*) FILTER (quality = 0) AS invalid,
  count(*) FILTER (quality IS NULL) AS unannotated, count(*) FILTER (lang <> 'en') AS excluded
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ROLLUP (source)""")
def ingest_breakdown(spark: SparkSession, d: str) -> DataFrame:
    """Counts per subfolder and overall."""
    return docs_labels(spark, d).rollup("source").agg(F.count("*").alias("total"), F.count_if(F.expr("quality = 1")).alias("valid"), F.count_if(F.expr("quality = 0")).alias("invalid"), F.count_if(F.expr("quality IS NULL")).alias("unannotated"), F.count_if(F.expr("lang <> 'en'")).alias("excluded")).withColumn("source", F.coalesce("source", F.lit("(all)")))


@query(f"""WITH {S.IMAGE_PATHS_SQL}
SELECT lower(regexp_extract(path, '\\.([^./]*)$', 1)) AS ext, count(*) AS files FROM image_paths GROUP BY 1""")
def extension_histogram(spark: SparkSession, d: str) -> DataFrame:
    return S.image_paths(spark, d).groupBy(P.extension(F.col("path")).alias("ext")).agg(F.count("*").alias("files"))


@query(f"""WITH {S.IMAGE_PATHS_SQL}
SELECT path FROM image_paths WHERE lower(regexp_extract(path, '\\.([^./]*)$', 1)) NOT IN ('jpg', 'jpeg', 'png', 'bmp', 'tif', 'tiff', 'webp') ORDER BY path LIMIT 20""")
def unsupported_files(spark: SparkSession, d: str) -> DataFrame:
    """The first 20 files that are no images."""
    return S.image_paths(spark, d).where(~P.extension(F.col("path")).isin(P.IMAGE_EXTENSIONS)).select("path").orderBy("path").limit(20)


@query(f"""WITH {S.IMAGE_PATHS_SQL}
SELECT regexp_extract(path, '^data/([^/]+)/', 1) AS subfolder, count(*) AS images, count(*) FILTER (lower(regexp_extract(path, '\\.([^./]*)$', 1)) IN ('jpg', 'jpeg', 'png', 'bmp')) AS flat_images
FROM image_paths WHERE lower(regexp_extract(path, '\\.([^./]*)$', 1)) IN ('jpg', 'jpeg', 'png', 'bmp', 'tif', 'tiff', 'webp') GROUP BY 1""")
def image_listing(spark: SparkSession, d: str) -> DataFrame:
    """Images of each subfolder, and those that the flat scan accepts."""
    p = F.col("path")
    return S.image_paths(spark, d).where(P.extension(p).isin(P.IMAGE_EXTENSIONS)).groupBy(P.subfolder(p, "data").alias("subfolder")).agg(F.count("*").alias("images"), F.count_if(P.extension(p).isin(P.FLAT_EXTENSIONS)).alias("flat_images"))


@query(r"""
SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url, '([^/]*)$', 1) AS leaf,
  regexp_replace(regexp_extract(url, '([^/]*)$', 1), '[?#].*$', '') AS stem FROM pages""")
def path_parse(spark: SparkSession, d: str) -> DataFrame:
    leaf = P.name(F.col("url"))
    return table(spark, d, "pages").select("page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), leaf.alias("leaf"), F.regexp_replace(leaf, "[?#].*$", "").alias("stem"))


_MODALITY = "CASE WHEN lower(path) LIKE '%/rgb-d/%' AND lower(regexp_extract(path, '([^/]*)$', 1)) NOT LIKE '%\\_color%' ESCAPE '\\' THEN 'depth' ELSE 'rgb' END"


@query(f"""WITH {S.IMAGE_PATHS_SQL}
SELECT source, count(*) FILTER (m = 'rgb') AS kept, count(*) FILTER (m <> 'rgb') AS excluded FROM (SELECT source, {_MODALITY} AS m FROM image_paths) GROUP BY source""")
def modality_filter(spark: SparkSession, d: str) -> DataFrame:
    m = P.modality(F.col("path"))
    return S.image_paths(spark, d).groupBy("source").agg(F.count_if(m == "rgb").alias("kept"), F.count_if(m != "rgb").alias("excluded"))


_VARIANT = "regexp_matches(lower(regexp_extract(path, '([^/]*)$', 1)), '^(horflip_|vertflip_|topwarp_|bottomwarp_|leftwarp_|rightomwarp_)')"


@query(f"""WITH {S.IMAGE_PATHS_SQL}
SELECT doc_id, path FROM image_paths WHERE {_MODALITY} = 'rgb' AND NOT {_VARIANT}""")
def variant_filter(spark: SparkSession, d: str) -> DataFrame:
    """Colour images that are no generated variants."""
    p = F.col("path")
    return S.image_paths(spark, d).where((P.modality(p) == "rgb") & ~P.is_variant(p)).select("doc_id", "path")


@query(f"""WITH {S.IMAGE_PATHS_SQL}
SELECT doc_id, regexp_replace(regexp_replace(regexp_extract(path, '([^/]*)$', 1), '\\.[^.]*$', ''), '^(horflip_|vertflip_|topwarp_|bottomwarp_|leftwarp_|rightomwarp_)', '', 'i') AS provenance FROM image_paths""")
def provenance_key(spark: SparkSession, d: str) -> DataFrame:
    return S.image_paths(spark, d).select("doc_id", P.provenance(F.col("path")).alias("provenance"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'none' ELSE 'yolo_txt' END AS fmt,
  CASE WHEN doc_id % 10 = 0 OR quality IS NULL THEN 'unannotated' WHEN quality = 0 OR n_chars < 200 THEN 'invalid_annotation' ELSE 'valid' END AS status
FROM documents LEFT JOIN labels USING (doc_id)""")
def status_case(spark: SparkSession, d: str) -> DataFrame:
    """Image status from its annotation: label = record, quality 0 = invalid, short text = no boxes."""
    fmt = F.when(F.col("doc_id") % 10 == 0, "none").otherwise("yolo_txt")
    return docs_labels(spark, d).select("doc_id", fmt.alias("fmt"), F.when((fmt == "none") | F.col("quality").isNull(), "unannotated").when((F.col("quality") == 0) | (F.col("n_chars") < 200), "invalid_annotation").otherwise("valid").alias("status"))


@query("""
WITH k AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'f' || doc_id || '.png' WHEN doc_id % 3 = 1 THEN 'f' || doc_id END AS key FROM labels)
SELECT d.doc_id, CASE WHEN a.key IS NOT NULL THEN 'name' WHEN b.key IS NOT NULL THEN 'stem' ELSE 'none' END AS matched_by, coalesce(a.doc_id, b.doc_id) AS record
FROM documents d LEFT JOIN k a ON a.key = 'f' || d.doc_id || '.png' LEFT JOIN k b ON b.key = 'f' || d.doc_id""")
def fallback_key_join(spark: SparkSession, d: str) -> DataFrame:
    """Records by file name, else by stem."""
    k = table(spark, d, "labels").select(F.col("doc_id").alias("rec"), F.expr("CASE WHEN doc_id % 3 = 0 THEN concat('f', doc_id, '.png') WHEN doc_id % 3 = 1 THEN concat('f', doc_id) END").alias("key"))
    docs = table(spark, d, "documents").selectExpr("doc_id", "concat('f', doc_id, '.png') AS by_name", "concat('f', doc_id) AS by_stem")
    a, b = k.select(F.col("rec").alias("rec_a"), F.col("key").alias("by_name")), k.select(F.col("rec").alias("rec_b"), F.col("key").alias("by_stem"))
    return docs.join(a, "by_name", "left").join(b, "by_stem", "left").select("doc_id", F.expr("CASE WHEN rec_a IS NOT NULL THEN 'name' WHEN rec_b IS NOT NULL THEN 'stem' ELSE 'none' END").alias("matched_by"), F.coalesce("rec_a", "rec_b").alias("record"))


# --- boxes ---------------------------------------------------------------------

_REASON = """CASE WHEN class_id NOT IN (0) THEN 'class' WHEN x < -0.001 OR x > 1.001 THEN 'x' WHEN y < -0.001 OR y > 1.001 THEN 'y' WHEN w <= 0 OR h <= 0 THEN 'nonpos'
  WHEN w > 1.001 OR h > 1.001 THEN 'dim' WHEN w * h < 0.00001 THEN 'area_min' WHEN w * h > 1 THEN 'area_max'
  WHEN x - w / 2 < -0.001 OR x + w / 2 > 1.001 OR y - h / 2 < -0.001 OR y + h / 2 > 1.001 THEN 'edge' ELSE 'ok' END"""


def _xywh():
    return [F.col(c) for c in "xywh"]


def _reason():
    return F.coalesce(B.reason(F.col("class_id"), *_xywh(), [0]), F.lit("ok"))


@query(f"WITH {S.BOXES_SQL} SELECT image_id, line_no, part_id, {_REASON} AS reason, count(*) AS n FROM boxes GROUP BY ALL")
def box_validate(spark: SparkSession, d: str) -> DataFrame:
    return S.boxes(spark, d).groupBy("image_id", "line_no", "part_id", _reason().alias("reason")).agg(F.count("*").alias("n"))


@query(f"WITH {S.WIDE_SQL} SELECT {_REASON} AS reason, count(*) AS boxes FROM boxes GROUP BY 1")
def box_reason_histogram(spark: SparkSession, d: str) -> DataFrame:
    return S.boxes(spark, d, wide=True).groupBy(_reason().alias("reason")).agg(F.count("*").alias("boxes"))


def _clip(e: str) -> str:
    return f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, {e}))"


_X1, _X2, _Y1, _Y2 = _clip("x - w / 2"), _clip("x + w / 2"), _clip("y - h / 2"), _clip("y + h / 2")


def _six(e: str) -> str:
    return f"round_even(({e}) * 1000000::DOUBLE, 0) / 1000000::DOUBLE"


_SANITIZED = f"{_six(f'({_X1} + {_X2}) / 2')} AS x, {_six(f'({_Y1} + {_Y2}) / 2')} AS y, {_six(f'{_X2} - {_X1}')} AS w, {_six(f'{_Y2} - {_Y1}')} AS h"


@query(f"""WITH {S.WIDE_SQL} SELECT image_id, line_no, part_id, {_SANITIZED} FROM boxes WHERE w > 0 AND h > 0""")
def box_sanitize(spark: SparkSession, d: str) -> DataFrame:
    return S.boxes(spark, d, wide=True).where("w > 0 AND h > 0").select("image_id", "line_no", "part_id", *(v.alias(k) for k, v in B.sanitize(*_xywh()).items()))


_SIZES_SQL = f"SELECT *, {S.WIDTH} + image_id % 7 * 100 AS iw, {S.HEIGHT} + image_id % 5 * 90 AS ih FROM boxes"


def _sized(spark: SparkSession, d: str) -> DataFrame:
    return S.boxes(spark, d).selectExpr("*", f"CAST({S.WIDTH} + image_id % 7 * 100 AS INT) AS iw", f"CAST({S.HEIGHT} + image_id % 5 * 90 AS INT) AS ih")


@query(f"""WITH {S.BOXES_SQL}, z AS ({_SIZES_SQL}), s AS (SELECT *, least({S.TARGET}::DOUBLE / iw, {S.TARGET}::DOUBLE / ih) AS scale FROM z),
p AS (SELECT *, ({S.TARGET} - round_even(iw * scale, 0)) / 2 AS pad_w, ({S.TARGET} - round_even(ih * scale, 0)) / 2 AS pad_h FROM s),
t AS (SELECT image_id, line_no, part_id, scale, pad_w, pad_h, (x * iw * scale + pad_w) / {S.TARGET} AS x, (y * ih * scale + pad_h) / {S.TARGET} AS y, w * iw * scale / {S.TARGET} AS w, h * ih * scale / {S.TARGET} AS h FROM p)
SELECT image_id, line_no, part_id, scale, pad_w, pad_h, {_SANITIZED} FROM t""")
def letterbox_geometry(spark: SparkSession, d: str) -> DataFrame:
    iw, ih = F.col("iw").cast("double"), F.col("ih").cast("double")
    g = B.letterbox(iw, ih, S.TARGET)
    box = B.letterbox_box(*_xywh(), iw, ih, S.TARGET)
    return _sized(spark, d).select("image_id", "line_no", "part_id", *(v.alias(k) for k, v in (g | box).items()))


@query(f"""WITH {S.BOXES_SQL}, z AS ({_SIZES_SQL})
SELECT image_id, line_no, part_id, CAST(round_even((x - w / 2) * iw, 0) AS INT) AS x1, CAST(round_even((y - h / 2) * ih, 0) AS INT) AS y1,
  CAST(round_even((x + w / 2) * iw, 0) AS INT) AS x2, CAST(round_even((y + h / 2) * ih, 0) AS INT) AS y2 FROM z""")
def box_pixel_corners(spark: SparkSession, d: str) -> DataFrame:
    return _sized(spark, d).select("image_id", "line_no", "part_id", *(v.alias(k) for k, v in B.corners(*_xywh(), F.col("iw"), F.col("ih")).items()))


@query(f"""WITH {S.BOXES_SQL} SELECT r_regionkey AS class_id, r_name AS class_name, count(image_id) AS boxes
FROM region LEFT JOIN boxes ON boxes.class_id = r_regionkey GROUP BY ALL""")
def class_distribution(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of each class, classes without boxes too."""
    n = S.boxes(spark, d).groupBy("class_id").agg(F.count("*").alias("boxes"))
    return table(spark, d, "region").join(n, F.col("r_regionkey") == F.col("class_id"), "left").select(F.col("r_regionkey").alias("class_id"), F.col("r_name").alias("class_name"), long(F.col("boxes")).alias("boxes"))


# --- duplicates ----------------------------------------------------------------


def _first(spark: SparkSession, d: str) -> DataFrame:
    return dedup.first_of(table(spark, d, "documents"), F.md5("text"), "doc_id")


_FIRST = "f AS (SELECT *, min(doc_id) OVER (PARTITION BY md5(text)) AS representative FROM documents)"


@query(f"WITH {_FIRST} SELECT doc_id, source FROM f WHERE doc_id = representative")
def exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return _first(spark, d).where("doc_id = representative").select("doc_id", "source")


@query("""WITH g AS (SELECT md5(text) AS h, 'exact_group_' || row_number() OVER (ORDER BY min(doc_id)) AS name, min(doc_id) AS representative, count(*) AS copies FROM documents GROUP BY md5(text) HAVING count(*) > 1)
SELECT name, representative, copies, doc_id AS member FROM documents JOIN g ON md5(text) = h""")
def exact_groups(spark: SparkSession, d: str) -> DataFrame:
    """A row for each member of each group of copies, the groups numbered by their first member."""
    g = dedup.exact_groups(table(spark, d, "documents").select("doc_id", "text"), F.md5("text"), "doc_id")
    named = dedup.ordinal(g.select("representative").distinct(), "exact_group_", "representative")
    return g.join(named, "representative").select("name", "representative", "copies", "member")


@query(f"WITH {_FIRST} SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.doc_id = d.doc_id AND f.doc_id <> representative)")
def dedup_retained(spark: SparkSession, d: str) -> DataFrame:
    gone = _first(spark, d).where("doc_id <> representative").select("doc_id")
    return table(spark, d, "documents").select("doc_id").join(gone, "doc_id", "left_anti")


@query(f"""WITH {_FIRST}, {S.PAIRS_SQL.format(t=8)}
SELECT doc_id FROM f WHERE doc_id <> representative UNION SELECT j FROM pairs""")
def dup_union(spark: SparkSession, d: str) -> DataFrame:
    """Exact duplicates and near ones, each once."""
    near = dedup.near_pairs(S.hashes(spark, d), 8).select(F.col("j").alias("doc_id"))
    return _first(spark, d).where("doc_id <> representative").select("doc_id").union(near).distinct()


@query(f"WITH {S.PAIRS_SQL.format(t=8)} SELECT i, j, d FROM pairs")
def near_pairs(spark: SparkSession, d: str) -> DataFrame:
    """At 8 bits: an equi-join on five bands, one bit of a band flipped."""
    return dedup.near_pairs(S.hashes(spark, d), 8)


@query(f"WITH {S.PAIRS_SQL.format(t=14)} SELECT i, j, d FROM pairs")
def near_pairs_wide(spark: SparkSession, d: str) -> DataFrame:
    """At 14 bits: all pairs, block by block."""
    return dedup.near_pairs(S.hashes(spark, d), 14)


_LEADERS = """,
adj AS (SELECT row_number() OVER (ORDER BY i) AS rn, i, js FROM (SELECT i, list(j) AS js FROM pairs GROUP BY i)),
walk AS (
  SELECT 0::BIGINT AS rn, []::BIGINT[] AS visited, NULL::BIGINT AS lead
  UNION ALL
  SELECT adj.rn, CASE WHEN list_contains(visited, adj.i) THEN visited ELSE list_concat(visited, adj.js) END, CASE WHEN list_contains(visited, adj.i) THEN NULL ELSE adj.i END
  FROM walk JOIN adj ON adj.rn = walk.rn + 1),
groups AS (SELECT min(i) AS leader, j AS member FROM pairs WHERE i IN (SELECT lead FROM walk WHERE lead IS NOT NULL) GROUP BY j)"""


@query(f"WITH RECURSIVE {S.PAIRS_SQL.format(t=8)}{_LEADERS} SELECT leader, member FROM groups")
def near_leader_groups(spark: SparkSession, d: str) -> DataFrame:
    return dedup.near_leaders(S.hashes(spark, d), 8)


@query(f"""WITH RECURSIVE {S.PAIRS_SQL.format(t=8)}{_LEADERS}, {_FIRST}
SELECT (SELECT count(*) FROM documents) AS evaluated, (SELECT count(*) FROM f WHERE doc_id <> representative) AS exact, (SELECT count(*) FROM groups) AS near,
  (SELECT count(*) FROM (SELECT doc_id FROM f WHERE doc_id <> representative UNION SELECT member FROM groups)) AS removed,
  (SELECT count(DISTINCT representative) FROM f WHERE doc_id <> representative) + (SELECT count(DISTINCT leader) FROM groups) AS groups""")
def dedup_report(spark: SparkSession, d: str) -> DataFrame:
    exact = _first(spark, d).where("doc_id <> representative").select("doc_id", "representative")
    near = near_leader_groups(spark, d)
    parts = [
        table(spark, d, "documents").agg(F.count("*").alias("evaluated")),
        exact.agg(F.count("*").alias("exact"), F.count_distinct("representative").alias("ge")),
        near.agg(F.count("*").alias("near"), F.count_distinct("leader").alias("gn")),
        exact.select("doc_id").union(near.select("member")).distinct().agg(F.count("*").alias("removed")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(F.broadcast(p))  # one row each
    return out.selectExpr("evaluated", "exact", "near", "removed", "ge + gn AS groups")


@query(f"WITH {_FIRST} SELECT r.source, count(*) AS duplicates FROM f JOIN documents r ON r.doc_id = f.representative WHERE f.doc_id <> f.representative GROUP BY r.source")
def duplicates_by_subfolder(spark: SparkSession, d: str) -> DataFrame:
    """Duplicates, counted where their representative is."""
    gone = _first(spark, d).where("doc_id <> representative").select("representative")
    return gone.join(table(spark, d, "documents").select(F.col("doc_id").alias("representative"), "source"), "representative").groupBy("source").agg(F.count("*").alias("duplicates"))


# --- quality -------------------------------------------------------------------


@query(f"""WITH {S.BOXES_SQL} SELECT image_id, count(*) AS boxes, count(*) FILTER (w * h BETWEEN 0.0001 AND 0.2) AS kept,
  count(*) FILTER (NOT (w * h BETWEEN 0.0001 AND 0.2)) AS removed FROM boxes GROUP BY image_id""")
def quality_filter(spark: SparkSession, d: str) -> DataFrame:
    """Box area filter on nested box lists; images stay even without boxes."""
    nested = S.boxes(spark, d).groupBy("image_id").agg(F.collect_list(F.struct("class_id", *"xywh")).alias("boxes"))
    area = lambda b: b["w"] * b["h"]
    kept = F.filter("boxes", lambda b: (area(b) >= 0.0001) & (area(b) <= 0.2))
    return nested.select("image_id", F.size("boxes").cast("long").alias("boxes"), F.size(kept).cast("long").alias("kept"), (F.size("boxes") - F.size(kept)).cast("long").alias("removed"))


@query("""SELECT source, count(*) AS checked, count(*) FILTER (n_chars < 300) AS low_quality, count(*) FILTER (n_chars >= 300) AS passed,
  round(avg(n_chars), 6) AS mean_score FROM documents WHERE lang = 'en' GROUP BY source""")
def quality_report(spark: SparkSession, d: str) -> DataFrame:
    """Score filter (text length stands for sharpness) per subfolder."""
    low = F.col("n_chars") < 300
    return table(spark, d, "documents").where("lang = 'en'").groupBy("source").agg(F.count("*").alias("checked"), F.count_if(low).alias("low_quality"), F.count_if(~low).alias("passed"), F.round(F.avg("n_chars"), 6).alias("mean_score"))


@query("SELECT doc_id, 'score ' || n_chars || ' below 300' AS reason FROM documents WHERE n_chars < 300 ORDER BY doc_id LIMIT 50")
def rejection_details(spark: SparkSession, d: str) -> DataFrame:
    """The first 50 rejections."""
    return table(spark, d, "documents").where("n_chars < 300").orderBy("doc_id").limit(50).select("doc_id", F.concat(F.lit("score "), F.col("n_chars").cast("string"), F.lit(" below 300")).alias("reason"))


@query("SELECT source, quality, 'rejected/low_quality/' || source || '_' || doc_id || '.txt' AS target FROM documents JOIN labels USING (doc_id) WHERE quality = 0")
def quarantine_manifest(spark: SparkSession, d: str) -> DataFrame:
    return docs_labels(spark, d).where("quality = 0").select("source", "quality", F.concat(F.lit("rejected/low_quality/"), F.col("source"), F.lit("_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("target"))


# --- splits --------------------------------------------------------------------

_SPLIT = """g AS (SELECT md5(text) AS h, min(source) AS source, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY md5(text)),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('42|' || h), h) AS place, count(*) OVER (PARTITION BY source) AS n FROM g),
s AS (SELECT h, source, doc_id, copies, CASE WHEN place <= round_even(n * 0.7::DOUBLE, 0) THEN 'train' WHEN place <= round_even(n * 0.7::DOUBLE, 0) + round_even(n * 0.15::DOUBLE, 0) THEN 'val' ELSE 'test' END AS split FROM r)"""


def _split(spark: SparkSession, d: str) -> DataFrame:
    groups = table(spark, d, "documents").groupBy(F.md5("text").alias("h")).agg(F.min("source").alias("source"), F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    return split.group_split(groups, "source", "h")


@query(f"WITH {_SPLIT} SELECT doc_id, source, split FROM s")
def group_split(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d).select("doc_id", "source", "split")


@query(f"WITH {_SPLIT} SELECT split, count(*) AS images, count(quality) AS annotated, CAST(coalesce(sum(toxic), 0) AS BIGINT) AS flagged FROM s LEFT JOIN labels USING (doc_id) GROUP BY split")
def split_report(spark: SparkSession, d: str) -> DataFrame:
    """Documents -> exact deduplication -> group split -> report."""
    return _split(spark, d).join(table(spark, d, "labels"), "doc_id", "left").groupBy("split").agg(F.count("*").alias("images"), F.count("quality").alias("annotated"), long(F.sum("toxic")).alias("flagged"))


@query(f"WITH {_SPLIT} SELECT source, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test FROM s GROUP BY source")
def split_pivot(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d).groupBy("source").pivot("split", ["train", "val", "test"]).agg(F.count(F.lit(1))).na.fill(0)


@query("""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) AS place, count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN place <= floor(n * 0.7::DOUBLE) THEN 'train' WHEN place <= floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM r""")
def flat_split(spark: SparkSession, d: str) -> DataFrame:
    return split.flat_split(table(spark, d, "documents").select("doc_id"), "doc_id")


@query(f"WITH {_SPLIT} SELECT count(*) AS groups, count(*) FILTER (n > 1) AS leaking FROM (SELECT md5(text) AS h, count(DISTINCT split) AS n FROM documents JOIN s ON md5(text) = h GROUP BY 1)")
def split_leakage_check(spark: SparkSession, d: str) -> DataFrame:
    """No group of copies lies in two splits."""
    docs = table(spark, d, "documents").select(F.md5("text").alias("h"))
    n = docs.join(_split(spark, d).select("h", "split"), "h").groupBy("h").agg(F.count_distinct("split").alias("n"))
    return n.agg(F.count("*").alias("groups"), F.count_if(F.expr("n > 1")).alias("leaking"))


@query(f"WITH {_SPLIT} SELECT split, lang, count(*) AS n FROM s JOIN documents USING (doc_id) GROUP BY ALL")
def class_by_split(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d).join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id").groupBy("split", "lang").agg(F.count("*").alias("n"))


# --- statistics ----------------------------------------------------------------


@query("SELECT count(*) AS total, count(*) FILTER (quality = 1) AS valid, count(*) FILTER (quality = 0) AS quarantined FROM documents LEFT JOIN labels USING (doc_id)")
def dataset_stats(spark: SparkSession, d: str) -> DataFrame:
    return docs_labels(spark, d).agg(F.count("*").alias("total"), F.count_if(F.expr("quality = 1")).alias("valid"), F.count_if(F.expr("quality = 0")).alias("quarantined"))


@query(f"""WITH {_SPLIT}, b AS (SELECT l_orderkey AS doc_id, count(*) AS boxes FROM lineitem GROUP BY 1)
SELECT source, split, count(*) AS images, count(boxes) AS annotated, CAST(coalesce(sum(boxes), 0) AS BIGINT) AS boxes FROM s LEFT JOIN b USING (doc_id) GROUP BY GROUPING SETS ((source), (split))""")
def stats_by_group(spark: SparkSession, d: str) -> DataFrame:
    """Images, annotated images and boxes, by subfolder and by split."""
    b = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.count("*").alias("boxes"))
    joined = _split(spark, d).join(b, "doc_id", "left")
    return joined.groupingSets([["source"], ["split"]], "source", "split").agg(F.count("*").alias("images"), F.count("boxes").alias("annotated"), long(F.sum("boxes")).alias("boxes"))


@query(f"""WITH {S.BOXES_SQL} SELECT count(*) AS boxes, round(avg(w * h), 6) AS mean_area, round(stddev_pop(w * h), 6) AS std_area, round(min(w * h), 6) AS min_area, round(max(w * h), 6) AS max_area,
  round(avg(w), 6) AS mean_width, round(avg(h), 6) AS mean_height, round(count(*)::DOUBLE / count(DISTINCT image_id), 6) AS mean_objects FROM boxes HAVING count(*) > 0""")
def box_metrics(spark: SparkSession, d: str) -> DataFrame:
    a = F.col("w") * F.col("h")
    per = S.boxes(spark, d).groupBy("image_id").agg(F.count("*").alias("n"), F.sum(a).alias("s"), F.sum(a * a).alias("q"), F.min(a).alias("lo"), F.max(a).alias("hi"), F.sum("w").alias("w"), F.sum("h").alias("h"))
    n = F.sum("n")
    mean = F.sum("s") / n
    out = per.agg(n.alias("boxes"), F.round(mean, 6).alias("mean_area"), F.round(F.sqrt(F.greatest(F.lit(0.0), F.sum("q") / n - mean * mean)), 6).alias("std_area"), F.round(F.min("lo"), 6).alias("min_area"), F.round(F.max("hi"), 6).alias("max_area"), F.round(F.sum("w") / n, 6).alias("mean_width"), F.round(F.sum("h") / n, 6).alias("mean_height"), F.round(n / F.count("*"), 6).alias("mean_objects"))
    return out.where("boxes > 0")


@query(f"""WITH {S.BOXES_SQL} SELECT CAST(least(9, floor(w * h * 40)) AS BIGINT) AS bucket, count(*) AS boxes FROM boxes GROUP BY 1""")
def area_histogram(spark: SparkSession, d: str) -> DataFrame:
    return S.boxes(spark, d).groupBy(F.least(F.lit(9), F.floor(F.col("w") * F.col("h") * 40)).cast("long").alias("bucket")).agg(F.count("*").alias("boxes"))


@query("SELECT l_orderkey AS image_id, count(*) AS objects FROM lineitem GROUP BY 1")
def objects_per_image(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("image_id")).agg(F.count("*").alias("objects"))


@query("SELECT source, doc_id FROM documents JOIN labels USING (doc_id) QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 3")
def preview_sample(spark: SparkSession, d: str) -> DataFrame:
    """The first three annotated records of each subfolder."""
    w = W.partitionBy("source").orderBy("doc_id")
    return table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi").withColumn("k", F.row_number().over(w)).where("k <= 3").select("source", "doc_id")


# --- pairing and integrity -----------------------------------------------------


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def pairing_semi(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id", "left_semi")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pairing_anti(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id", "left_anti")


@query("SELECT source, count(*) FILTER (quality IS NOT NULL) AS skipped, count(*) FILTER (quality IS NULL) AS to_process FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source")
def auto_label_pending(spark: SparkSession, d: str) -> DataFrame:
    """Images that already have an annotation are skipped."""
    return docs_labels(spark, d).groupBy("source").agg(F.count_if(F.expr("quality IS NOT NULL")).alias("skipped"), F.count_if(F.expr("quality IS NULL")).alias("to_process"))


_SIDES = "(SELECT doc_id AS k FROM documents UNION SELECT -1 - doc_id FROM documents) i FULL JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) l ON i.k = l.k"


@query(f"SELECT coalesce(i.k, l.k) AS stem, CASE WHEN l.k IS NULL THEN 'no label' ELSE 'no image' END AS problem FROM {_SIDES} WHERE i.k IS NULL OR l.k IS NULL")
def stem_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Stems on one side only, of images (two for each document) and labels (one for each order)."""
    docs = table(spark, d, "documents")
    i = docs.select(F.col("doc_id").alias("a")).union(docs.select(-1 - F.col("doc_id"))).distinct()
    lab = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("b")).distinct()
    return i.join(lab, F.col("a") == F.col("b"), "full_outer").where("a IS NULL OR b IS NULL").select(F.coalesce("a", "b").alias("stem"), F.expr("CASE WHEN b IS NULL THEN 'no label' ELSE 'no image' END").alias("problem"))


@query("SELECT DISTINCT l_orderkey AS stem FROM lineitem WHERE l_orderkey NOT IN (SELECT doc_id FROM documents)")
def orphan_annotations(spark: SparkSession, d: str) -> DataFrame:
    """Labels (one for each order) without an image."""
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("stem")).distinct().join(table(spark, d, "documents").select(F.col("doc_id").alias("stem")), "stem", "left_anti")


@query(f"""WITH {S.BOXES_SQL}, t AS (
  SELECT CASE WHEN image_id % 10 < 7 THEN 'train' WHEN image_id % 10 < 9 THEN 'val' ELSE 'test' END AS split, image_id, {_REASON} AS reason FROM boxes)
SELECT split, count(DISTINCT image_id) AS images, count(*) FILTER (reason = 'ok') AS valid_boxes, count(*) FILTER (reason <> 'ok') AS errors, count(*) FILTER (reason <> 'ok') = 0 AS valid FROM t GROUP BY split""")
def final_integrity(spark: SparkSession, d: str) -> DataFrame:
    """Final label rows re-validated per split."""
    t = S.boxes(spark, d).select(F.expr("CASE WHEN image_id % 10 < 7 THEN 'train' WHEN image_id % 10 < 9 THEN 'val' ELSE 'test' END").alias("split"), "image_id", _reason().alias("reason"))
    return t.groupBy("split").agg(F.count_distinct("image_id").alias("images"), F.count_if(F.expr("reason = 'ok'")).alias("valid_boxes"), F.count_if(F.expr("reason <> 'ok'")).alias("errors"), (F.count_if(F.expr("reason <> 'ok'")) == 0).alias("valid"))


@query(f"""WITH {S.BOXES_SQL} SELECT image_id, line_no, part_id, x, y, w, h, {_REASON} AS reason FROM boxes WHERE {_REASON} <> 'ok' ORDER BY image_id, line_no, part_id, x, y, w, h LIMIT 100""")
def integrity_errors(spark: SparkSession, d: str) -> DataFrame:
    """The first 100 invalid label rows."""
    return S.boxes(spark, d).withColumn("reason", _reason()).where("reason <> 'ok'").select("image_id", "line_no", "part_id", *"xywh", "reason").orderBy("image_id", "line_no", "part_id", *"xywh").limit(100)


_COIN = "CAST('0x' || substr(md5('42|flip|' || image_id), 1, 4) AS BIGINT) < 32768"


@query(f"""WITH {S.BOXES_SQL} SELECT image_id, line_no, part_id, class_id, CASE WHEN image_id % 10 < 7 AND {_COIN} THEN 1 - x ELSE x END AS x, y, w, h FROM boxes""")
def augment_flip_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Horizontal flip of training boxes, by a coin that the image id alone decides."""
    coin = F.conv(F.substring(F.md5(F.concat(F.lit("42|flip|"), F.col("image_id").cast("string"))), 1, 4), 16, 10).cast("long") < 32768
    return S.boxes(spark, d).withColumn("x", F.when((F.col("image_id") % 10 < 7) & coin, 1 - F.col("x")).otherwise(F.col("x"))).select("image_id", "line_no", "part_id", "class_id", *"xywh")


@query("""SELECT event_id, event_type, value FROM events WHERE value / 20 >= 0.5""")
def confidence_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").where(F.col("value") / 20 >= 0.5).select("event_id", "event_type", "value")


@query(f"""WITH {S.BOXES_SQL}, r AS (SELECT image_id, count(*) AS boxes, count(*) FILTER ({_REASON} <> 'ok') AS bad FROM boxes GROUP BY image_id)
SELECT count(*) AS records, count(*) FILTER (bad < boxes) AS valid, count(*) FILTER (bad = boxes) AS invalid, CAST(sum(boxes) AS BIGINT) AS boxes, CAST(sum(bad) AS BIGINT) AS invalid_boxes FROM r""")
def annotation_report(spark: SparkSession, d: str) -> DataFrame:
    """Records with at least one valid box, and boxes that fail."""
    r = S.boxes(spark, d).withColumn("reason", _reason()).groupBy("image_id").agg(F.count("*").alias("boxes"), F.count_if(F.expr("reason <> 'ok'")).alias("bad"))
    return r.agg(F.count("*").alias("records"), F.count_if(F.expr("bad < boxes")).alias("valid"), F.count_if(F.expr("bad = boxes")).alias("invalid"), long(F.sum("boxes")).alias("boxes"), long(F.sum("bad")).alias("invalid_boxes"))


@query(f"""WITH {S.BOXES_SQL} SELECT DISTINCT image_id, {_REASON} AS issue FROM boxes WHERE {_REASON} <> 'ok' ORDER BY 1, 2 LIMIT 50""")
def annotation_issues(spark: SparkSession, d: str) -> DataFrame:
    """The first 50 issues."""
    return S.boxes(spark, d).select("image_id", _reason().alias("issue")).where("issue <> 'ok'").distinct().orderBy("image_id", "issue").limit(50)


@query(f"""WITH {S.IMAGE_PATHS_SQL} SELECT doc_id, CASE WHEN source IN ('src1', 'src2') THEN 'train' ELSE 'other' END AS part, regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder,
  source || '_' || regexp_extract(path, '([^/]*)$', 1) AS output_name FROM image_paths""")
def output_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of processed images."""
    p = F.col("path")
    return S.image_paths(spark, d).select("doc_id", F.when(F.col("source").isin("src1", "src2"), "train").otherwise("other").alias("part"), P.folder(p).alias("folder"), F.concat("source", F.lit("_"), P.name(p)).alias("output_name"))
