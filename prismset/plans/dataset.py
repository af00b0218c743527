"""The image pipeline: scan, validate, deduplicate, filter, split, resize, augment, write.

Each stage is a DataFrame; nothing runs before a report or a writer asks for it.
Images and labels are matched by their path without extension, those of COCO files
by file name within the subfolder. Images are decoded twice: once to score them,
after which a table without pixels is kept in the shared folder, and once for those
that are written.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from prismset.functions import boxes as B
from prismset.functions import paths as P
from prismset.operators import dedup, pixels, split
from prismset.sources import annotations as A
from prismset.sources import files as S
from prismset.streaming import ingest

BOX = "array<struct<class_id:int,x:double,y:double,w:double,h:double>>"
ISSUES, ERRORS = 50, 100
PREVIEWS = 3


def label_files(spark: SparkSession, config: dict) -> DataFrame:
    """(lpath, content, lkey, ext, folder, name, fmt) of the label files; ``fmt`` is their subfolder's format."""
    root, labels = S.input_folder(config["input_path"]), config.get("input", {}).get("yolo_labels_dir")
    if labels and "://" not in labels:
        labels = (Path.cwd() / labels).resolve().as_posix()
        if not Path(labels).is_dir():
            raise FileNotFoundError(f"there is no labels folder {labels}")
    found = S.contents(spark, labels or root, ["txt"] if labels else ["txt", "xml", "json"])
    files = found.select(F.col("path").alias("lpath"), F.col("content").cast("string").alias("content")).where(~P.name(F.col("path")).isin(A.NOT_LABELS))
    l = F.col("lpath")
    files = files.withColumns({"lkey": P.stem(l) if labels else F.regexp_replace(l, r"\.[^./]*$", ""), "ext": P.extension(l), "name": P.name(l)})
    if labels:
        return files.withColumns({"folder": F.lit(None).cast("string"), "fmt": F.lit("yolo_txt")})
    files = files.withColumn("folder", P.subfolder(l, root))
    return files.join(A.detect(files.select(F.col("folder").alias("subfolder"), "name", "content")).withColumnRenamed("subfolder", "folder"), "folder")


def listing(spark: SparkSession, config: dict) -> DataFrame:
    """(path, subfolder) of all image files, whatever the modality: for the counts of what is left out."""
    root = S.input_folder(config["input_path"])
    paths = spark.read.format("binaryFile").option("pathGlobFilter", S.pattern(P.IMAGE_EXTENSIONS)).option("recursiveFileLookup", "true").load(root).select(S.plain("path").alias("path"))
    return paths.withColumn("subfolder", P.subfolder(F.col("path"), root))


def scan(spark: SparkSession, config: dict) -> DataFrame:
    """Images with subfolder, modality, provenance, label boxes, format of the labels, status and what is wrong."""
    root = S.input_folder(config["input_path"])
    images = pixels.read_images(spark, root, P.IMAGE_EXTENSIONS)
    p = F.col("path")
    images = images.where(P.modality(p) == "rgb")
    if config.get("input", {}).get("exclude_generated_variants", True):
        images = images.where(~P.is_variant(p))
    images = images.withColumns({"subfolder": P.subfolder(p, root), "stem": P.stem(p), "provenance": P.provenance(p), "key": F.regexp_replace(p, r"\.[^./]*$", "")})
    labels = config.get("input", {}).get("yolo_labels_dir")
    files = label_files(spark, config)
    text = files.where("ext = 'txt' AND fmt NOT IN ('coco_json', 'voc_xml')")
    text = text.groupBy("lkey").agg(F.max_by("content", "lpath").alias("content"))
    lines = text.select("lkey", F.explode(F.split("content", "\n")).alias("line"))
    found = A.yolo_strict(lines, "line", list(config["classes"])).groupBy("lkey").agg(F.collect_list(F.struct("class_id", *"xywh")).alias("boxes"))
    text = text.select("lkey").join(found, "lkey", "left")
    out = images.join(text, F.col("stem" if labels else "key") == F.col("lkey"), "left").withColumn("labelled", F.col("lkey").isNotNull()).drop("lkey").withColumn("error", F.lit(None).cast("string"))
    if not labels:
        out = _with_coco(_with_voc(out, files, config), files, config)
    fmt = files.select(F.col("folder").alias("subfolder"), F.col("fmt").alias("label_format")).distinct() if not labels else None
    out = out.join(fmt, "subfolder", "left") if fmt is not None else out.withColumn("label_format", F.lit("yolo_txt"))
    out = out.withColumn("label_format", F.coalesce("label_format", F.lit("none")))
    out = out.withColumn("status", F.when(F.col("corrupted"), "corrupted").when(~F.col("labelled"), "unannotated").when(F.coalesce(F.size("boxes"), F.lit(0)) <= 0, "invalid_annotation").otherwise("valid"))
    return out.withColumn("boxes", F.coalesce("boxes", F.array().cast(BOX)))


def _with_voc(images: DataFrame, files: DataFrame, config: dict) -> DataFrame:
    """``images`` with the boxes of the VOC file beside each, in subfolders of that format."""
    xml = files.where("ext = 'xml' AND fmt = 'voc_xml'").select(F.col("lkey").alias("key"), F.col("content").alias("_xml"))
    out = images.join(xml, "key", "left").withColumnsRenamed({"boxes": "_boxes"})
    out = A.voc_boxes(out, "_xml", {v: k for k, v in config["classes"].items()}, F.col("width"), F.col("height"))
    has = F.col("_xml").isNotNull()
    return out.withColumns({"boxes": F.when(has, F.col("boxes")).otherwise(F.col("_boxes")), "error": F.when(has, F.col("error")), "labelled": has | F.col("labelled")}).drop("_xml", "_boxes", "valid")


def first_json(files: DataFrame) -> DataFrame:
    """(folder, lpath) of the COCO file that counts for each subfolder: the first by path."""
    return files.where("ext = 'json' AND fmt = 'coco_json'").groupBy("folder").agg(F.min("lpath").alias("lpath"))


def _with_coco(images: DataFrame, files: DataFrame, config: dict) -> DataFrame:
    """``images`` with the boxes of their subfolder's COCO file, by file name, else by stem."""
    docs = files.join(first_json(files), ["folder", "lpath"], "left_semi").select("lpath", "folder", "content")
    listed = A.coco_images(docs, "lpath", "content").join(docs.select("lpath", "folder"), "lpath").select("lpath", "folder", "file_name").distinct()
    found = A.coco_boxes(docs, "lpath", "content", {v: k for k, v in config["classes"].items()})
    found = found.groupBy("lpath", "file_name").agg(F.collect_list(F.struct("class_id", *"xywh")).alias("boxes"))
    listed = listed.join(found, ["lpath", "file_name"], "left").withColumn("boxes", F.coalesce("boxes", F.array().cast(BOX)))
    f = F.col("file_name")

    def by(key: Column, name: str) -> DataFrame:
        # of several entries of one name the first with boxes counts
        return listed.groupBy(F.col("folder").alias("subfolder"), key.alias(name)).agg(F.min_by("boxes", F.struct(F.size("boxes") == 0, "file_name")).alias(f"_{name}"))

    out = images.withColumn("file", P.name(F.col("path"))).join(by(P.name(f), "file"), ["subfolder", "file"], "left").join(by(P.stem(f), "stem"), ["subfolder", "stem"], "left")
    coco = F.coalesce("_file", "_stem")
    return out.withColumns({"boxes": F.coalesce(coco, "boxes"), "labelled": coco.isNotNull() | F.col("labelled")}).drop("file", "_file", "_stem")


def ingestion_report(listed: DataFrame, images: DataFrame) -> list[dict]:
    """Counts for each subfolder and over all: images by status, those left out, the labels' format."""
    p = F.col("path")
    depth = P.modality(p) != "rgb"
    left = listed.groupBy("subfolder").agg(F.count_if(depth).alias("excluded_modality"), F.count_if(~depth & P.is_variant(p)).alias("variants"))
    status = lambda s: F.count_if(F.col("status") == s).alias(s)
    seen = images.groupBy("subfolder").agg(F.count("*").alias("total"), *(status(s) for s in ("valid", "corrupted", "unannotated", "invalid_annotation")), F.count_if((F.col("status") == "unannotated") & F.col("labelled")).alias("empty_annotations"), F.max("label_format").alias("label_format"))
    each = left.join(seen, "subfolder", "full_outer").na.fill(0)
    every = each.agg(F.lit("(all)").alias("subfolder"), *(F.sum(c).alias(c) for c in each.columns if c not in ("subfolder", "label_format")), F.lit(None).cast("string").alias("label_format"))
    return [r.asDict() for r in each.select(every.columns).unionByName(every).orderBy("subfolder").collect()]


def annotation_report(images: DataFrame, classes: dict[int, str]) -> dict:
    """Records and boxes of the labelled images, boxes of every class, the first issues."""
    own = images.where("labelled AND NOT corrupted")
    counts = own.agg(F.count("*").alias("records"), F.count_if(F.size("boxes") > 0).alias("valid_records"), F.count_if(F.size("boxes") == 0).alias("invalid_records"), F.coalesce(F.sum(F.size("boxes")), F.lit(0)).alias("boxes"))
    found = {r["class_id"]: r["n"] for r in own.select(F.explode("boxes.class_id").alias("class_id")).groupBy("class_id").agg(F.count("*").alias("n")).collect()}  # a row for each class
    issues = own.where("size(boxes) = 0").select("path", F.coalesce("error", F.lit("no valid box")).alias("error")).orderBy("path").limit(ISSUES).collect()
    return counts.first().asDict() | {"classes": {n: found.get(k, 0) for k, n in sorted(classes.items())}, "issues": [r.asDict() for r in issues]}


def malformed_lines(spark: SparkSession, config: dict) -> list[dict]:
    """The first lines of YOLO files that hold no valid box, and why."""
    files = label_files(spark, config).where("ext = 'txt' AND fmt = 'yolo_txt'")
    lines = files.select(F.col("lpath").alias("file"), F.posexplode(F.split("content", "\n")).alias("line_no", "line")).where("trim(line) <> ''")
    bad = ingest.validated(lines, list(config["classes"])).where("reason IS NOT NULL").orderBy("file", "line_no").limit(ERRORS)
    return [r.asDict() for r in bad.select("file", "line_no", "reason").collect()]


def score(images: DataFrame, config: dict) -> DataFrame:
    """``images`` with md5, perceptual hash halves and blur variance of the valid ones."""
    method = config.get("deduplication", {}).get("method", "phash")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            a = [pixels.array(*r) for r in zip(b["data"], b["height"], b["width"], b["channels"], strict=True)]
            h = [pixels.perceptual_hash(x, method) + (1 << 63) for x in a]
            yield pd.DataFrame({"path": b["path"], "lo": [x & 0xFFFFFFFF for x in h], "hi": [x >> 32 for x in h], "blur": [pixels.blur_variance(x) for x in a]})

    scored = images.where("status = 'valid'").select("path", "data", "height", "width", "channels").mapInPandas(run, "path string, lo long, hi long, blur double")
    return images.withColumn("md5", F.md5("data")).join(scored, "path", "left")


def duplicate_groups(images: DataFrame, config: dict) -> DataFrame:
    """(path, leader, kind) of the valid images that copy an earlier path or are near an earlier leader."""
    valid = images.where("status = 'valid'")
    exact = dedup.first_of(valid.select("path", "md5"), F.col("md5"), "path").where("path <> representative").select("path", F.col("representative").alias("leader"), F.lit("exact").alias("kind"))
    left = valid.join(exact, "path", "left_anti").select(F.col("path").alias("i"), "lo", "hi")
    near = dedup.near_leaders(left, config["deduplication"]["threshold"]).select(F.col("member").alias("path"), "leader", F.lit("near").alias("kind"))
    return exact.unionByName(near)


def deduplicate(images: DataFrame, groups: DataFrame) -> DataFrame:
    """Images that ``duplicate_groups`` lists become ``duplicate``; ``grp`` is what a group shares, its leader too."""
    every = groups.select("path", "leader").union(groups.select("leader", "leader")).groupBy("path").agg(F.min("leader").alias("grp"))
    out = images.join(groups.select("path", F.lit(True).alias("gone")), "path", "left").join(every, "path", "left")
    return out.withColumn("status", F.when(F.col("gone"), "duplicate").otherwise(F.col("status"))).drop("gone")


def deduplication_report(images: DataFrame, groups: DataFrame) -> dict:
    """Copies by kind, groups, what stays, and copies by the subfolder of their leader."""
    where = images.select(F.col("path").alias("leader"), "subfolder")
    by = groups.join(where, "leader").groupBy("subfolder").agg(F.count("*").alias("n")).orderBy("subfolder").collect()  # a row for each subfolder
    out = groups.agg(F.count_if(F.col("kind") == "exact").alias("exact"), F.count_if(F.col("kind") == "near").alias("near"), F.count_distinct("kind", "leader").alias("groups")).first().asDict()
    kept = images.agg(F.count_if(F.col("status").isin("valid", "duplicate")).alias("evaluated"), F.count_if(F.col("status") != "duplicate").alias("retained")).first().asDict()
    return kept | out | {"removed": out["exact"] + out["near"], "by_subfolder": {r["subfolder"]: r["n"] for r in by}}


def filter_quality(images: DataFrame, config: dict) -> DataFrame:
    """Blurred images become ``low_quality``; boxes outside the area range go."""
    q = config["quality"]
    blur = q["blur"]
    area = lambda b: b["w"] * b["h"]
    out = images.withColumn("boxes", F.filter("boxes", lambda b: (area(b) >= q["min_box_area_ratio"]) & (area(b) <= q["max_box_area_ratio"])))
    if not blur["enabled"]:
        return out
    return out.withColumn("status", F.when((F.col("status") == "valid") & (F.col("blur") < blur["threshold"]), "low_quality").otherwise(F.col("status")))


def quality_report(images: DataFrame, before: DataFrame, config: dict) -> dict:
    """Images and boxes that the filter took, by subfolder, and the first reasons."""
    limit = config["quality"]["blur"]["threshold"]
    gone = images.where("status = 'low_quality'")
    boxes = lambda df: df.where("status IN ('valid', 'low_quality')").agg(F.coalesce(F.sum(F.size("boxes")), F.lit(0)).alias("n")).first()["n"]
    by = {r["subfolder"]: r["n"] for r in gone.groupBy("subfolder").agg(F.count("*").alias("n")).collect()}  # a row for each subfolder
    first = gone.orderBy("path").limit(ISSUES).select("path", F.format_string(f"blur variance %.3f below {limit:g}", "blur").alias("reason")).collect()
    return {"checked": before.where("status = 'valid'").count(), "blurred": sum(by.values()), "passed": images.where("status = 'valid'").count(), "boxes_removed": boxes(before) - boxes(images), "by_subfolder": by, "rejections": [r.asDict() for r in first]}


def split_images(images: DataFrame, config: dict) -> DataFrame:
    """Valid images with ``split``: whole groups of copies, else of one source image, stratified by subfolder."""
    s = config["split"]
    valid = images.where("status = 'valid'").withColumn("unit", F.coalesce("grp", F.concat(F.lit("source_"), F.col("subfolder"), F.lit("_"), F.col("provenance"))))
    groups = split.group_split(valid.select("subfolder", "unit").distinct(), "subfolder", "unit", s["train"], s["validation"], s["seed"])
    return valid.join(groups, ["subfolder", "unit"])


def normalisation(config: dict) -> dict:
    """What is said about pixel values; images are always stored as bytes."""
    return {"enabled": config.get("normalization", {}).get("enabled", False), "stored_range": [0, 255], "stored_type": "uint8", "done_by": "the trainer, as it loads a batch"}


def write(images: DataFrame, config: dict, augment: bool) -> DataFrame:
    """Letterboxed images (train ones augmented) and label files in the output folder.

    ``images`` hold pixels. Returns (path, split, boxes) of what was written. File
    names hold a hash of the path, so files of one name in two folders do not
    overwrite each other. The folder, or address, must be one that all executors reach.
    """
    target, colour = config["resize"]["target_size"], tuple(config["resize"].get("padding_color", [114, 114, 114]))
    out, aug, seed = config["output_path"], config.get("augmentation", {}), config["split"]["seed"]
    moved = images.withColumn("boxes", F.transform("boxes", lambda b: F.struct(b["class_id"].alias("class_id"), *(v.alias(k) for k, v in B.letterbox_box(*(b[c] for c in "xywh"), F.col("width").cast("double"), F.col("height").cast("double"), target).items()))))

    def one(r: tuple) -> tuple:
        a = pixels.letterbox(pixels.array(r.data, r.height, r.width, r.channels), target, colour)
        boxes = np.array([[x["class_id"], x["x"], x["y"], x["w"], x["h"]] for x in r.boxes], float).reshape(-1, 5)
        if augment and r.split == "train":
            a, boxes = pixels.augment(a, boxes, aug, r.path, seed)
        name = f"{r.subfolder}_{r.stem}_{r.tag}"
        S.put(out, f"{r.split}/images/{name}.png", pixels.png(a))
        S.put(out, f"{r.split}/labels/{name}.txt", "".join(f"{int(c)} {x:.6f} {y:.6f} {w:.6f} {h:.6f}\n" for c, x, y, w, h in boxes).encode())
        return r.path, r.split, len(boxes)

    cols = ["path", "subfolder", "stem", "split", "data", "height", "width", "channels", "boxes"]
    return S.each(moved.select(*cols, F.substring(F.md5("path"), 1, 8).alias("tag")), one, "path string, split string, boxes long")


def quarantine(images: DataFrame, folder: str) -> DataFrame:
    """Copies of the rejected files, in a folder for each status; (path, status, copied).

    A file that is there already stays as it is; one that can't be copied is only
    listed as such.
    """
    rejected = images.where(~F.col("status").isin("valid", "unannotated")).select("path", "status", F.concat_ws("_", "subfolder", P.name(F.col("path"))).alias("name"))
    files = images.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true")

    def one(r: tuple) -> tuple:
        try:
            S.put(folder, f"{r.status}/{r.name}", r.content, replace=False)
        except OSError:
            return r.path, r.status, False
        return r.path, r.status, True

    roots = [r["root"] for r in images.select("root").distinct().collect()]  # one
    found = files.load(roots[0]).select(S.plain("path").alias("path"), "content") if roots else None
    return S.each(rejected.join(found, "path"), one, "path string, status string, copied boolean") if roots else rejected.select("path", "status", F.lit(False).alias("copied"))


def previews(images: DataFrame, folder: str, each: int = PREVIEWS) -> int:
    """The first annotated images (with pixels) of each subfolder with their boxes drawn; how many."""

    def one(r: tuple) -> tuple:
        px = [tuple(round(v * n) for v, n in ((x["x"] - x["w"] / 2, r.width), (x["y"] - x["h"] / 2, r.height), (x["x"] + x["w"] / 2, r.width), (x["y"] + x["h"] / 2, r.height))) for x in r.boxes]
        S.put(folder, f"{r.subfolder}_{r.stem}.png", pixels.png(pixels.draw_boxes(pixels.array(r.data, r.height, r.width, r.channels), px)))
        return (1,)

    rows = images.select("subfolder", "stem", "data", "height", "width", "channels", "boxes")
    return S.each(rows, one, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]


def first_of_each(images: DataFrame, each: int = PREVIEWS) -> DataFrame:
    """The first valid annotated images of each subfolder, by path."""
    k = F.row_number().over(W.partitionBy("subfolder").orderBy("path"))
    return images.where("status = 'valid' AND size(boxes) > 0").withColumn("k", k).where(F.col("k") <= each).drop("k")


def statistics(images: DataFrame) -> dict:
    """Totals, and size statistics of the boxes (left out if there are none)."""
    out = images.agg(F.count("*").alias("total_images"), F.count_if(F.col("status") == "valid").alias("valid_images"), F.count_if(~F.col("status").isin("valid", "unannotated")).alias("quarantined_images")).first().asDict()
    b = images.where("status = 'valid'").select("path", F.explode("boxes").alias("b"))
    a = F.col("b.w") * F.col("b.h")
    m = b.agg(F.count("*").alias("total_boxes"), F.avg(a).alias("mean_area"), F.stddev_pop(a).alias("std_area"), F.min(a).alias("min_area"), F.max(a).alias("max_area"), F.avg("b.w").alias("mean_width"), F.avg("b.h").alias("mean_height")).first().asDict()
    return out | (m if m["total_boxes"] else {})


def integrity(spark: SparkSession, config: dict) -> dict:
    """Every label row of the output checked again; stems of images and labels must agree."""
    root = config["output_path"]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", S.pattern(["png", "txt"])).load(root)
    p = F.col("path")
    files = files.select(S.plain("path").alias("path"), "content").withColumns({"split": F.regexp_extract(p, "/([^/]+)/(images|labels)/[^/]+$", 1), "kind": F.regexp_extract(p, "/([^/]+)/[^/]+$", 1), "stem": P.stem(p)})
    sides = files.groupBy("split", "stem").agg(F.max(F.col("kind") == "images").alias("image"), F.max(F.col("kind") == "labels").alias("label"))
    rows = files.where("kind = 'labels'").select("split", "path", F.explode(F.split(F.col("content").cast("string"), "\n")).alias("line")).where("trim(line) <> ''")
    checked = ingest.validated(rows, list(config["classes"]))
    out: dict = {"valid": True, "errors": [f"{r.path}: {r.reason}" for r in checked.where("reason IS NOT NULL").orderBy("path", "line").limit(ERRORS).collect()]}
    counts = {r["split"]: r.asDict() for r in sides.groupBy("split").agg(F.count_if("image").alias("images"), F.count_if("label").alias("labels"), F.count_if(F.col("image") != F.col("label")).alias("odd")).collect()}  # three rows
    boxes = {r["split"]: r["n"] for r in checked.where("reason IS NULL").groupBy("split").agg(F.count("*").alias("n")).collect()}
    for name in ("train", "val", "test"):
        c = counts.get(name, {"images": 0, "labels": 0, "odd": 0})
        out[name] = {"images": c["images"], "labels": c["labels"], "boxes": boxes.get(name, 0)}
        if c["odd"]:
            out["errors"].append(f"{name}: images and labels differ")
    out["errors"] = out["errors"][:ERRORS]
    out["valid"] = not out["errors"]
    return out


def report(df: DataFrame, *by: str) -> list[dict]:
    """Images, annotated ones and boxes by group: a few rows."""
    return [r.asDict() for r in df.groupBy(*by).agg(F.count("*").alias("images"), F.count_if(F.size("boxes") > 0).alias("annotated"), F.sum(F.size("boxes")).alias("boxes")).orderBy(*by).collect()]


def clear_output(config: dict) -> None:
    """Make room for the output, if the settings allow it."""
    import shutil

    target = Path(config["output_path"])
    if target.exists() and any(target.iterdir()):
        if not config.get("output", {}).get("overwrite", False):
            raise FileExistsError(f"{target} exists; set output.overwrite to replace it")
        shutil.rmtree(target)


def run(spark: SparkSession, config: dict, stage: str | None = None) -> dict:
    """All stages up to ``stage``; JSON reports in the reports folder."""
    out: dict = {}
    reports = config["reports_path"]
    root = S.input_folder(config["input_path"])

    def note(name: str, rows: object) -> None:
        out[name] = rows
        S.put(reports, f"{name}.json", json.dumps(rows, indent=2).encode())

    def with_pixels(rows: DataFrame) -> DataFrame:
        raw = pixels.read_images(spark, root, P.IMAGE_EXTENSIONS)
        return rows.join(raw.select("path", "data"), "path")

    note("config_snapshot", config)
    found = dedup._stored(score(scan(spark, config), config).drop("data").withColumn("root", F.lit(root)))
    note("ingestion_report", ingestion_report(listing(spark, config), found))
    if stage == "ingestion":
        return out
    note("annotation_report", annotation_report(found, config["classes"]))
    note("malformed_labels", malformed_lines(spark, config))
    if stage == "validation":
        return out
    if found.where("status = 'valid'").isEmpty():
        if config.get("annotation", {}).get("mode", "require") == "require":
            raise RuntimeError("no annotated valid image; set annotation.mode to manual-later for an audit only")
        return out
    groups = dedup._stored(duplicate_groups(found, config))
    unique = dedup._stored(deduplicate(found, groups))
    note("deduplication_report", deduplication_report(unique, groups))
    if stage == "deduplication":
        return out
    images = filter_quality(unique, config)
    note("quality_report", quality_report(images, unique, config))
    note("quarantine", [r.asDict() for r in quarantine(images, config["rejected_path"]).groupBy("status", "copied").count().orderBy("status", "copied").collect()])
    if stage == "quality_filter":
        return out
    placed = dedup._stored(split_images(images, config))
    note("split_report", report(placed, "split", "subfolder"))
    if stage == "split":
        return out
    clear_output(config)
    written = dedup._stored(write(with_pixels(placed), config, augment=stage != "resize"))
    note("output_report", [r.asDict() for r in written.groupBy("split").agg(F.count("*").alias("images"), F.sum("boxes").alias("boxes")).orderBy("split").collect()])
    S.put(config["output_path"], "data.yaml", S.data_yaml(config["output_path"], config["classes"]))
    note("normalization", normalisation(config))
    note("dataset_statistics", {"before": statistics(found), "after": statistics(images)})
    shown = {"before": first_of_each(found), "after": first_of_each(images)}
    note("previews", {when: previews(with_pixels(rows), f"{config['experiments_path']}/previews/{when}") for when, rows in shown.items()})
    note("final_integrity_report", integrity(spark, config))
    note("summary", {"images": found.count(), "written": written.count(), "statuses": {r["status"]: r["n"] for r in images.groupBy("status").agg(F.count("*").alias("n")).orderBy("status").collect()}, "valid": out["final_integrity_report"]["valid"]})
    if not out["final_integrity_report"]["valid"]:
        raise RuntimeError("the written dataset is invalid, see final_integrity_report.json")
    return out
