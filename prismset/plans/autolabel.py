"""Labels for images that have none, from a predictor of one's own."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismset.functions import boxes as B
from prismset.functions import paths as P
from prismset.operators import pixels
from prismset.sources import annotations as A
from prismset.sources import files as S

#: From BGR pixels to rows of x1, y1, x2, y2, score, in pixels.
Predictor = Callable[[np.ndarray], np.ndarray]


def label(spark: SparkSession, root: str, predictor: Predictor, name: str, confidence: float = 0.5) -> DataFrame:
    """(path, xml, boxes) for every image below ``root`` without a VOC file beside it.

    Boxes under the confidence go, others are clamped to the image, and those left
    without extent go as well.
    """
    key = lambda c: F.regexp_replace(F.col(c), r"\.[^./]*$", "")
    images = pixels.read_images(spark, S.input_folder(root), P.FLAT_EXTENSIONS).where("NOT corrupted")
    done = S.contents(spark, S.input_folder(root), ["xml"]).select(key("path").alias("key"))
    todo = images.withColumn("key", key("path")).join(done, "key", "left_anti")

    def one(r: tuple) -> tuple:
        found = np.asarray(predictor(pixels.array(r.data, r.height, r.width, r.channels)), float).reshape(-1, 5)
        return r.path, r.width, r.height, [dict(zip(("x1", "y1", "x2", "y2", "score"), map(float, b), strict=True)) for b in found]

    said = S.each(todo.select("path", "data", "height", "width", "channels"), one, "path string, width int, height int, found array<struct<x1:double,y1:double,x2:double,y2:double,score:double>>")
    sure = F.filter("found", lambda b: b["score"] >= confidence)
    cut = F.transform(sure, lambda b: F.struct(F.lit(name).alias("name"), *(v.alias(k) for k, v in B.clamp_corners(b["x1"], b["y1"], b["x2"], b["y2"], F.col("width"), F.col("height")).items())))
    kept = said.withColumn("objects", F.filter(cut, lambda b: (b["x2"] > b["x1"]) & (b["y2"] > b["y1"])))
    return kept.select("path", A.voc_xml(P.name(F.col("path")), F.col("width"), F.col("height"), F.col("objects")).alias("xml"), F.size("objects").cast("long").alias("boxes"))


def write(labels: DataFrame) -> DataFrame:
    """The VOC files beside their images; (path, boxes) of what was written."""

    def one(r: tuple) -> tuple:
        folder, _, file = r.path.rpartition("/")
        S.put(folder, f"{file.rpartition('.')[0]}.xml", r.xml.encode())
        return r.path, r.boxes

    return S.each(labels, one, "path string, boxes long")
