"""The flat pipeline: one folder of images, one of label texts, a plain split of the labelled ones."""

from __future__ import annotations

import json
import shutil
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismset.functions import paths as P
from prismset.operators import dedup, split
from prismset.sources import annotations as A
from prismset.sources import files as S


def pairs(spark: SparkSession, images: str, labels: str) -> DataFrame:
    """(path, stem, lpath, cleaned) of the images right in a folder; ``lpath`` is null without a label text of that stem."""
    found = S.contents(spark, images, P.FLAT_EXTENSIONS, deep=False).select("path").withColumn("stem", P.stem(F.col("path")))
    texts = S.contents(spark, labels, ["txt"], deep=False).select(F.col("path").alias("lpath"), F.col("content").cast("string").alias("content")).withColumn("stem", P.stem(F.col("lpath")))
    lines = A.yolo_lenient(texts.select("stem", F.posexplode(F.split("content", "\n")).alias("no", "line")), "line")
    kept = lines.groupBy("stem").agg(F.array_sort(F.collect_list(F.struct("no", "cleaned")))["cleaned"].alias("cleaned"))
    return found.join(texts.select("stem", "lpath").join(kept, "stem", "left"), "stem", "left").withColumn("cleaned", F.coalesce("cleaned", F.array().cast("array<string>")))


def run(spark: SparkSession, images: str, labels: str, output: str, reports: str, classes: dict[int, str], train: float = 0.7, val: float = 0.15, seed: int = 42) -> dict:
    """Copy the labelled images with cleaned labels into splits; the report, also written as JSON.

    The output folder is replaced. Images of one stem and different extension keep
    their own file and share the label.
    """
    found = dedup._stored(pairs(spark, S.input_folder(images), S.input_folder(labels)))
    placed = split.flat_split(found.where("lpath IS NOT NULL").select("path", "stem", "cleaned"), "path", train, val, seed)
    if "://" not in output and Path(output).exists():
        shutil.rmtree(output)

    def one(r: tuple) -> tuple:
        S.put(output, f"{r.split}/images/{r.name}", r.content)
        S.put(output, f"{r.split}/labels/{r.stem}.txt", "".join(f"{line}\n" for line in r.cleaned).encode())
        return r.split, len(r.cleaned)

    rows = placed.join(S.contents(spark, S.input_folder(images), P.FLAT_EXTENSIONS, deep=False), "path").withColumn("name", P.name(F.col("path")))
    written = S.each(rows.select("split", "name", "stem", "cleaned", "content"), one, "split string, boxes long")
    stats = {r["split"]: {"images": r["images"], "boxes": r["boxes"]} for r in written.groupBy("split").agg(F.count("*").alias("images"), F.sum("boxes").alias("boxes")).collect()}  # three rows
    splits = {s: stats.get(s, {"images": 0, "boxes": 0}) for s in ("train", "val", "test")}
    S.put(output, "data.yaml", S.data_yaml(output, classes))
    total, labelled = found.count(), found.where("lpath IS NOT NULL").count()
    report = {"valid": sum(s["images"] for s in splits.values()) == labelled, "images": total, "labelled": labelled, "unlabelled": total - labelled, "boxes": sum(s["boxes"] for s in splits.values()), "splits": splits}
    S.put(reports, "final_integrity_report.json", json.dumps(report, indent=2).encode())
    return report
