"""Annotation formats: YOLO text, Pascal VOC XML, COCO JSON, and their detection."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from prismset.functions import boxes as B
from prismset.functions import paths as P

VOC = "size struct<width:int,height:int>, object array<struct<name:string,bndbox:struct<xmin:double,ymin:double,xmax:double,ymax:double>>>"
COCO = (
    "images array<struct<id:bigint,file_name:string,width:int,height:int>>, annotations array<struct<image_id:bigint,category_id:bigint,bbox:array<double>>>, "
    "categories array<struct<id:bigint,name:string>>"
)
#: Text files that are no annotations, files looked at for a vote.
NOT_LABELS = ["classes.txt", "README.txt"]
VOTE_FILES = 20


def tokens(line: Column) -> Column:
    return F.split(F.trim(F.translate(line, "\t\r", "  ")), " +")


def number(t: Column) -> Column:
    return t.try_cast("double")


def numbers(line: Column) -> Column:
    """An array with one struct of the line: tokens ``n`` and the first five as numbers ``c``, ``x``, ``y``, ``w``, ``h``.

    As a bound variable the tokens are worked out once, whatever is asked of them.
    """
    return F.transform(F.array(tokens(line)), lambda t: F.struct(F.size(t).alias("n"), *(number(F.get(t, k)).alias(c) for k, c in enumerate("cxywh"))))


def yolo_strict(lines: DataFrame, line: str, allowed: list[int]) -> DataFrame:
    """``lines`` with class_id, x, y, w, h of the valid ones: exactly five numbers, a whole class id."""

    def good(b: Column) -> Column:
        whole = (b["n"] == 5) & (b["c"] == F.floor(b["c"])) & b["x"].isNotNull() & b["y"].isNotNull() & b["w"].isNotNull() & b["h"].isNotNull()
        return whole & B.reason(b["c"], *(b[k] for k in "xywh"), allowed).isNull()

    box = F.transform(F.filter(numbers(F.col(line)), good), lambda b: F.struct(b["c"].cast("int").alias("class_id"), *(b[k].alias(k) for k in "xywh")))
    return lines.select("*", F.inline(box))


def yolo_lenient(lines: DataFrame, line: str) -> DataFrame:
    """``lines`` with ``cleaned``: five or more tokens, the id cut to a whole number, coordinates in [0, 1]."""

    def good(b: Column) -> Column:
        ok = (b["n"] >= 5) & (F.abs(b["c"]) < 2.0**31)
        for k in "xywh":
            ok = ok & b[k].between(0.0, 1.0)
        return ok

    made = F.transform(F.filter(numbers(F.col(line)), good), lambda b: yolo_line(b["c"].cast("int"), *(b[k] for k in "xywh")))
    return lines.select("*", F.explode(made).alias("cleaned"))


def yolo_line(class_id: Column, x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.format_string("%d %.6f %.6f %.6f %.6f", class_id, x, y, w, h)


def voc_boxes(docs: DataFrame, xml: str, class_map: dict[str, int], width: Column, height: Column) -> DataFrame:
    """``docs`` with ``boxes`` (valid ones), ``valid`` and ``error``.

    A positive size in the XML beats the image's. A class outside ``class_map``
    makes the whole record invalid; boxes without extent or out of bounds go.
    """
    ids = F.create_map(*(F.lit(x) for kv in class_map.items() for x in kv))
    d = docs.withColumn("_x", F.from_xml(F.col(xml), VOC))
    own = (F.col("_x.size.width") > 0) & (F.col("_x.size.height") > 0)
    d = d.withColumn("_w", F.when(own, F.col("_x.size.width")).otherwise(width).cast("double")).withColumn("_h", F.when(own, F.col("_x.size.height")).otherwise(height).cast("double"))
    objects = F.coalesce("_x.object", F.array().cast("array<struct<name:string,bndbox:struct<xmin:double,ymin:double,xmax:double,ymax:double>>>"))
    d = d.withColumn("_o", objects)

    def box(o: Column) -> Column:
        b = o["bndbox"]
        c = B.from_corners(b["xmin"], b["ymin"], b["xmax"], b["ymax"], F.col("_w"), F.col("_h"))
        return F.struct(ids[o["name"]].alias("class_id"), *(c[k].alias(k) for k in "xywh"))

    made = F.filter(F.transform("_o", box), lambda b: F.coalesce((b["w"] > 0) & (b["h"] > 0), F.lit(False)) & B.reason(b["class_id"], *(b[k] for k in "xywh"), list(class_map.values())).isNull())
    error = (
        F.when(F.col("_x").isNull() | (F.col("_x.size").isNull() & F.col("_x.object").isNull()), "unreadable")
        .when((F.col("_w") <= 0) | (F.col("_h") <= 0), "no size")
        .when(F.exists("_o", lambda o: ~F.map_contains_key(ids, o["name"])), "unknown class")
    )
    d = d.withColumn("error", error)
    return d.withColumn("boxes", F.when(F.col("error").isNull(), made).otherwise(F.array().cast("array<struct<class_id:int,x:double,y:double,w:double,h:double>>"))).withColumn("valid", F.col("error").isNull()).drop("_x", "_w", "_h", "_o")


def coco_images(files: DataFrame, key: str, content: str) -> DataFrame:
    """(key, image_id, file_name, width, height) of COCO files; of images with one id the last counts."""
    listed = files.select(key, F.posexplode(F.from_json(F.col(content), COCO)["images"]).alias("at", "i"))
    last = listed.groupBy(key, F.col("i.id").alias("image_id")).agg(F.max_by("i", "at").alias("i"))
    return last.select(key, "image_id", "i.file_name", "i.width", "i.height")


def coco_boxes(files: DataFrame, key: str, content: str, class_map: dict[str, int]) -> DataFrame:
    """(key, file_name, class_id, x, y, w, h) of every valid box of COCO files.

    Annotations look up their file's categories (the last of an id counts) and join
    its images. An unknown category skips the box, an id without category takes the
    first class; images without a positive size have no boxes.
    """
    ids = F.create_map(*(F.lit(x) for kv in class_map.items() for x in kv))
    d = files.select(key, F.from_json(F.col(content), COCO).alias("j")).select(key, F.explode("j.annotations").alias("a"), F.col("j.categories").alias("c"))
    named = F.get(F.reverse(F.filter("c", lambda c: c["id"] == F.col("a.category_id"))), 0)["name"]
    notes = d.select(key, "a.image_id", "a.bbox", ids[F.coalesce(named, F.lit(next(iter(class_map))))].alias("class_id"))
    notes = notes.where("class_id IS NOT NULL AND size(bbox) = 4 AND bbox[2] > 0 AND bbox[3] > 0")
    j = notes.join(coco_images(files, key, content).where("width > 0 AND height > 0"), [key, "image_id"])
    b = [F.get("bbox", k) for k in range(4)]
    c = B.from_corners(b[0], b[1], b[0] + b[2], b[1] + b[3], F.col("width").cast("double"), F.col("height").cast("double"))
    box = F.struct("class_id", *(c[k].alias(k) for k in "xywh"))
    valid = F.filter(F.array(box), lambda v: B.reason(v["class_id"], *(v[k] for k in "xywh"), list(class_map.values())).isNull())
    return j.select(key, "file_name", F.inline(valid))


def custom_boxes(files: DataFrame, fmt: str, convert: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(path, boxes, valid, error) of files in a format of one's own: what ``convert`` makes of them.

    Without a converter every record is invalid and says so.
    """
    if convert is not None:
        return convert(files)
    said = F.concat(F.lit(f"no converter for the format {fmt}: "), F.col("path"))
    return files.select("path", F.array().cast("array<struct<class_id:int,x:double,y:double,w:double,h:double>>").alias("boxes"), F.lit(False).alias("valid"), said.alias("error"))


def detect(files: DataFrame) -> DataFrame:
    """(subfolder, fmt) from (subfolder, name, content): COCO, VOC, YOLO by majority, custom, none.

    The vote takes the first VOTE_FILES text files by name.
    """
    ext = P.extension(F.col("name"))
    f = files.withColumn("ext", ext).withColumn("label", (ext == "txt") & ~F.col("name").isin(NOT_LABELS))
    lines = F.filter(F.split("content", "\n"), lambda x: F.trim(x) != "")

    def good(line: Column) -> Column:
        t = tokens(line)
        v = [number(F.get(t, k)) for k in range(5)]
        ok = (F.size(t) == 5) & F.coalesce(v[0] == F.floor(v[0]), F.lit(False))
        for x in v[1:]:
            ok = ok & F.coalesce(x.between(0.0, 1.0), F.lit(False))
        return ok

    # of each folder only the first names are kept, in every task before they meet
    first = W.partitionBy("subfolder").orderBy("name")
    looked = f.where("label").withColumn("k", F.row_number().over(first)).where(F.col("k") <= VOTE_FILES)
    vote = looked.groupBy(F.col("subfolder").alias("_s")).agg(F.sum(F.size(F.filter(lines, good))).alias("good"), F.sum(F.size(lines)).alias("seen"))
    g = f.groupBy("subfolder").agg(
        F.max((F.col("ext") == "json") & F.col("content").rlike('(?s)^\\s*\\{.*"images"\\s*:') & F.col("content").rlike('"annotations"\\s*:')).alias("coco"),
        F.max((F.col("ext") == "xml") & (F.col("content").rlike("(?s)^\\s*(<\\?[^>]*>\\s*)?<annotation[\\s/>]") | F.col("content").contains("<object>"))).alias("voc"),
        F.max(F.col("label") | F.col("ext").isin("xml", "json")).alias("some"),
    )
    g = g.join(vote, F.col("subfolder") == F.col("_s"), "left")
    fmt = F.when(F.col("coco"), "coco_json").when(F.col("voc"), "voc_xml").when(F.col("good") * 2 > F.col("seen"), "yolo_txt").when(F.col("some"), "custom").otherwise("none")
    return g.select("subfolder", fmt.alias("fmt"))


def escaped(text: Column) -> Column:
    """``text`` as XML character data."""
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(mark), F.lit(name))
    return text


def voc_xml(name: Column, width: Column, height: Column, objects: Column) -> Column:
    """A VOC document; ``objects`` is an array of (name, x1, y1, x2, y2)."""
    one = lambda o: F.concat(F.lit("<object><name>"), escaped(o["name"]), F.lit("</name><bndbox><xmin>"), o["x1"].cast("string"), F.lit("</xmin><ymin>"), o["y1"].cast("string"), F.lit("</ymin><xmax>"), o["x2"].cast("string"), F.lit("</xmax><ymax>"), o["y2"].cast("string"), F.lit("</ymax></bndbox></object>"))
    return F.concat(F.lit("<annotation><filename>"), escaped(name), F.lit("</filename><size><width>"), width.cast("string"), F.lit("</width><height>"), height.cast("string"), F.lit("</height></size>"), F.array_join(F.transform(objects, one), ""), F.lit("</annotation>"))
