"""Expressions over file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefixes of generated variants, compared in lower case.
VARIANT_PREFIXES = ["horflip_", "vertflip_", "topwarp_", "bottomwarp_", "leftwarp_", "rightomwarp_"]
#: Extensions of images, of a recursive scan and of a flat one.
IMAGE_EXTENSIONS = ["jpg", "jpeg", "png", "bmp", "tif", "tiff", "webp"]
FLAT_EXTENSIONS = ["jpg", "jpeg", "png", "bmp"]


def name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(name(path), r"(?<=.)\.[^.]*$", "")


def extension(path: Column) -> Column:
    """Lower-case last extension, without the dot; empty if there is none."""
    return F.lower(F.regexp_extract(name(path), r".\.([^.]*)$", 1))


def folder(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def subfolder(path: Column, root: str) -> Column:
    """Top folder below ``root``; the root's own name for files right in it."""
    below = F.substring(path, len(root) + 2, 1 << 20)
    top = F.regexp_extract(below, "^([^/]+)/", 1)
    return F.when(~F.startswith(path, F.lit(f"{root}/")) | (top == ""), root.rsplit("/", 1)[-1]).otherwise(top)


def modality(path: Column) -> Column:
    """``depth`` for files below a folder RGB-D without _color in their name, else ``rgb``."""
    return F.when(F.array_contains(F.split(F.lower(path), "/"), "rgb-d") & ~F.lower(name(path)).contains("_color"), "depth").otherwise("rgb")


def is_variant(path: Column) -> Column:
    return F.lower(stem(path)).rlike("^(" + "|".join(VARIANT_PREFIXES) + ")")


def provenance(path: Column) -> Column:
    """The stem of the source image: one variant prefix taken off, case kept."""
    return F.regexp_replace(stem(path), "(?i)^(" + "|".join(VARIANT_PREFIXES) + ")", "")
