"""Bounding-box expressions: validation, sanitising, letterbox and pixel geometry.

A box is four double columns in normalised centre form (x, y, w, h). All
functions build expressions that stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOLERANCE = 1e-3
MIN_AREA = 1e-5
MAX_AREA = 1.0
#: The reasons of ``reason`` in the order in which they are tested.
REASONS = ["class", "x", "y", "nonpos", "dim", "area_min", "area_max", "edge"]


def reason(class_id: Column, x: Column, y: Column, w: Column, h: Column, allowed: list[int], tol: float = TOLERANCE, min_area: float = MIN_AREA, max_area: float = MAX_AREA) -> Column:
    """Why a box is invalid, the first failing test; null if it is valid.

    A NaN counts as larger than any number: as a centre it fails ``x`` or ``y``,
    as an extent ``dim``.
    """
    lo, hi = -tol, 1 + tol
    out = lambda c: (c < lo) | (c > hi)
    return (
        F.when(~class_id.isin(allowed), "class")
        .when(out(x), "x")
        .when(out(y), "y")
        .when((w <= 0) | (h <= 0), "nonpos")
        .when((w > hi) | (h > hi), "dim")
        .when(w * h < min_area, "area_min")
        .when(w * h > max_area, "area_max")
        .when((x - w / 2 < lo) | (x + w / 2 > hi) | (y - h / 2 < lo) | (y + h / 2 > hi), "edge")
    )


def clip(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def sanitize(x: Column, y: Column, w: Column, h: Column) -> dict[str, Column]:
    """Corners clipped to the unit square, rebuilt and rounded half-even to millionths."""
    x1, x2, y1, y2 = clip(x - w / 2), clip(x + w / 2), clip(y - h / 2), clip(y + h / 2)
    return {k: F.rint(v * 1e6) / 1e6 for k, v in (("x", (x1 + x2) / 2), ("y", (y1 + y2) / 2), ("w", x2 - x1), ("h", y2 - y1))}


def letterbox(width: Column, height: Column, target: int) -> dict[str, Column]:
    """Scale and (fractional) padding that fit an image into a square."""
    scale = F.least(target / width, target / height)
    return {"scale": scale, "pad_w": (target - F.bround(width * scale)) / 2, "pad_h": (target - F.bround(height * scale)) / 2}


def letterbox_box(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column, target: int) -> dict[str, Column]:
    """A box moved along with its image, then sanitised."""
    g = letterbox(width, height, target)
    return sanitize((x * width * g["scale"] + g["pad_w"]) / target, (y * height * g["scale"] + g["pad_h"]) / target, w * width * g["scale"] / target, h * height * g["scale"] / target)


def corners(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> dict[str, Column]:
    """Whole-pixel corners of a centre-form box (half-even rounding)."""
    px = lambda c, n: F.bround(c * n).cast("int")
    return {"x1": px(x - w / 2, width), "y1": px(y - h / 2, height), "x2": px(x + w / 2, width), "y2": px(y + h / 2, height)}


def from_corners(xmin: Column, ymin: Column, xmax: Column, ymax: Column, width: Column, height: Column) -> dict[str, Column]:
    """Centre form of pixel corners."""
    return {"x": (xmin + xmax) / 2 / width, "y": (ymin + ymax) / 2 / height, "w": (xmax - xmin) / width, "h": (ymax - ymin) / height}


def clamp_corners(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> dict[str, Column]:
    """Corners clamped to [0, size - 1] and cut to whole pixels."""
    c = lambda v, n: F.greatest(F.lit(0.0), F.least(v, n - 1.0)).cast("int")
    return {"x1": c(x1, width), "y1": c(y1, height), "x2": c(x2, width), "y2": c(y2, height)}
