"""Pixel operators in numpy, applied to Spark's image rows batch by batch.

Spark's ``image`` source decodes on the JVM to interleaved BGR bytes; a file that
can't be decoded is a row of height -1.
"""

from __future__ import annotations

import struct
import zlib
import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismset.functions import paths as P
from prismset.sources.files import pattern, plain

PAD = 114
#: Weights of blue, green and red in grey.
GREY = np.array([0.114, 0.587, 0.299])
MIN_VISIBILITY = 0.2


def read_images(spark: SparkSession, path: str, extensions: list[str]) -> DataFrame:
    """(path, height, width, channels, data, format, corrupted) of the images of these extensions under a path."""
    raw = spark.read.format("image").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern(extensions)).load(path)
    path_ = plain("image.origin")
    kind = F.upper(F.replace(F.replace(P.extension(path_), F.lit("jpg"), F.lit("jpeg")), F.lit("tiff"), F.lit("tif")))
    return raw.select(path_.alias("path"), "image.height", "image.width", F.col("image.nChannels").alias("channels"), "image.data", kind.alias("format"), (F.col("image.height") <= 0).alias("corrupted"))


def array(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """(height, width, 3) BGR bytes; grey is repeated, alpha left out."""
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.repeat(a, 3, axis=2) if channels == 1 else a[:, :, :3]


def grey(a: np.ndarray) -> np.ndarray:
    return a.astype(np.float64) @ GREY


def blur_variance(a: np.ndarray) -> float:
    """Population variance of the four-neighbour Laplacian, edges mirrored without repeating them."""
    g = np.rint(grey(a))
    p = np.pad(g, 1, mode="reflect") if min(g.shape) > 1 else np.pad(g, 1, mode="edge")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g).var())


def resize(a: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, pixel centres aligned."""
    y = np.clip((np.arange(height) + 0.5) * a.shape[0] / height - 0.5, 0, a.shape[0] - 1)
    x = np.clip((np.arange(width) + 0.5) * a.shape[1] / width - 0.5, 0, a.shape[1] - 1)
    y0, x0 = y.astype(int), x.astype(int)
    y1, x1 = np.minimum(y0 + 1, a.shape[0] - 1), np.minimum(x0 + 1, a.shape[1] - 1)
    fy, fx = (y - y0)[:, None], (x - x0)[None]
    if a.ndim == 3:
        fy, fx = fy[..., None], fx[..., None]
    f = a.astype(np.float64)
    top = f[y0][:, x0] * (1 - fx) + f[y0][:, x1] * fx
    low = f[y1][:, x0] * (1 - fx) + f[y1][:, x1] * fx
    return top * (1 - fy) + low * fy


def perceptual_hash(a: np.ndarray, method: str = "phash") -> int:
    """64 bits: ``phash`` (low DCT terms over their median), ``dhash`` (rising gradient), ``ahash`` (over the mean)."""
    g = np.rint(grey(a))
    if method == "phash":
        n = 32
        k = np.arange(n)
        dct = np.cos(np.pi * (2 * k[None] + 1) * k[:, None] / (2 * n))
        low = (dct @ resize(g, n, n) @ dct.T)[:8, :8]
        bits = low > np.median(low)
    elif method == "dhash":
        s = resize(g, 8, 9)
        bits = s[:, 1:] > s[:, :-1]
    elif method == "ahash":
        s = resize(g, 8, 8)
        bits = s > s.mean()
    else:
        raise ValueError(f"unknown hash method {method}")
    return int(np.packbits(bits.ravel()).view(">u8")[0]) - (1 << 63)


def letterbox(a: np.ndarray, target: int = 640, colour: tuple[int, int, int] = (PAD, PAD, PAD)) -> np.ndarray:
    """The image scaled into a square on a plain border."""
    h, w = a.shape[:2]
    scale = min(target / w, target / h)
    nh, nw = max(1, round(h * scale)), max(1, round(w * scale))
    out = np.empty((target, target, 3), np.uint8)
    out[:] = colour
    top, left = round((target - nh) / 2 - 0.1), round((target - nw) / 2 - 0.1)
    out[top : top + nh, left : left + nw] = np.clip(np.rint(resize(a, nh, nw)), 0, 255)
    return out


def png(a: np.ndarray) -> bytes:
    """BGR pixels as a PNG file."""
    rgb = np.ascontiguousarray(a[:, :, ::-1])
    rows = b"".join(b"\0" + r.tobytes() for r in rgb)
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", a.shape[1], a.shape[0], 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows, 6)) + chunk(b"IEND", b"")


def draw_boxes(a: np.ndarray, corners: list[tuple[int, int, int, int]], colour: tuple[int, int, int] = (0, 255, 0)) -> np.ndarray:
    """The image with the outline of each box."""
    out = a.copy()
    h, w = a.shape[:2]
    for x1, y1, x2, y2 in corners:
        x1, x2, y1, y2 = (int(np.clip(v, 0, n - 1)) for v, n in ((x1, w), (x2, w), (y1, h), (y2, h)))
        out[[y1, y2], x1 : x2 + 1] = colour
        out[y1 : y2 + 1, [x1, x2]] = colour
    return out


def _hull(points: np.ndarray) -> tuple[float, float, float, float]:
    x, y = points[:, 0], points[:, 1]
    return float(x.min()), float(y.min()), float(x.max()), float(y.max())


def flip(a: np.ndarray, boxes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out = boxes.copy()
    out[:, 1] = 1 - out[:, 1]
    return a[:, ::-1].copy(), out


def rotate(a: np.ndarray, boxes: np.ndarray, degrees: float) -> tuple[np.ndarray, np.ndarray]:
    """About the centre, plain border; a box becomes the hull of its turned corners."""
    h, w = a.shape[:2]
    c, s = np.cos(np.radians(degrees)), np.sin(np.radians(degrees))
    yy, xx = np.mgrid[:h, :w]
    dx, dy = xx - (w - 1) / 2, yy - (h - 1) / 2
    sx, sy = np.rint(c * dx - s * dy + (w - 1) / 2).astype(int), np.rint(s * dx + c * dy + (h - 1) / 2).astype(int)
    inside = (sx >= 0) & (sx < w) & (sy >= 0) & (sy < h)
    out = np.full_like(a, PAD)
    out[inside] = a[sy[inside], sx[inside]]
    turned = boxes.copy()
    for k, (_, x, y, bw, bh) in enumerate(boxes):
        p = np.array([[(x + i * bw / 2) * w - w / 2, (y + j * bh / 2) * h - h / 2] for i in (-1, 1) for j in (-1, 1)])
        q = np.stack([c * p[:, 0] + s * p[:, 1] + w / 2, -s * p[:, 0] + c * p[:, 1] + h / 2], axis=1)
        x1, y1, x2, y2 = _hull(q)
        turned[k, 1:] = (x1 + x2) / 2 / w, (y1 + y2) / 2 / h, (x2 - x1) / w, (y2 - y1) / h
    return out, turned


def shift_hsv(a: np.ndarray, hue: float, sat: float, val: float) -> np.ndarray:
    """Hue in half degrees, saturation and value in 0..255 steps."""
    f = a.astype(np.float64) / 255
    b, g, r = f[..., 0], f[..., 1], f[..., 2]
    v, m = f.max(axis=2), f.min(axis=2)
    d = np.where(v > m, v - m, 1)
    h = np.where(v == r, (g - b) / d % 6, np.where(v == g, (b - r) / d + 2, (r - g) / d + 4)) * (v > m)
    s = np.where(v > 0, (v - m) / np.where(v > 0, v, 1), 0)
    h, s, v = (h + hue / 30) % 6, np.clip(s + sat / 255, 0, 1), np.clip(v + val / 255, 0, 1)
    k = lambda n: v - v * s * np.clip(np.minimum((n + h) % 6, 4 - (n + h) % 6), 0, 1)
    return np.clip(np.rint(np.stack([k(1), k(3), k(5)], axis=2) * 255), 0, 255).astype(np.uint8)


def brightness_contrast(a: np.ndarray, brightness: float, contrast: float) -> np.ndarray:
    return np.clip(np.rint(a * (1 + contrast) + 255 * brightness), 0, 255).astype(np.uint8)


def motion_blur(a: np.ndarray, size: int, vertical: bool) -> np.ndarray:
    """Mean of ``size`` pixels along a line."""
    f, n = a.astype(np.float64), size // 2
    p = np.pad(f, ((n, n), (0, 0), (0, 0)) if vertical else ((0, 0), (n, n), (0, 0)), mode="edge")
    out = sum(p[k : k + a.shape[0]] if vertical else p[:, k : k + a.shape[1]] for k in range(2 * n + 1)) / (2 * n + 1)
    return np.rint(out).astype(np.uint8)


def augment(a: np.ndarray, boxes: np.ndarray, config: dict, key: str, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """A training image and its (class, x, y, w, h) boxes, transformed at random.

    All chances come from the key and the seed, so the result does not depend on
    the partitioning. Images without boxes stay as they are; boxes of which less
    than a fifth stays visible go; class ids stay whole numbers.
    """
    if not len(boxes):
        return a, boxes
    rng = np.random.default_rng([seed, zlib.crc32(key.encode())])
    on = lambda name, p: (c := config.get(name, {})).get("enabled", True) and rng.random() < c.get("probability", p)
    get = lambda name, field, default: config.get(name, {}).get(field, default)
    boxes = boxes.astype(float)
    if on("horizontal_flip", 0.5):
        a, boxes = flip(a, boxes)
    if on("rotation", 0.5):
        limit = get("rotation", "degrees", 15)
        a, boxes = rotate(a, boxes, rng.uniform(-limit, limit))
    if on("hsv", 0.5):
        a = shift_hsv(a, *(rng.uniform(-n, n) for n in (get("hsv", "hue_shift_limit", 10), get("hsv", "sat_shift_limit", 20), get("hsv", "val_shift_limit", 20))))
    if on("brightness_contrast", 0.5):
        b, c = get("brightness_contrast", "brightness_limit", 0.2), get("brightness_contrast", "contrast_limit", 0.2)
        a = brightness_contrast(a, rng.uniform(-b, b), rng.uniform(-c, c))
    if on("motion_blur", 0.3):
        a = motion_blur(a, int(rng.choice(np.arange(3, get("motion_blur", "blur_limit", 7) + 1, 2))), bool(rng.integers(2)))
    if on("occlusion_simulation", 0.3):
        a = a.copy()
        for _ in range(rng.integers(1, get("occlusion_simulation", "num_holes", 4) + 1)):
            h, w = (int(rng.integers(8, get("occlusion_simulation", n, 32) + 1)) for n in ("max_h_size", "max_w_size"))
            y, x = rng.integers(0, max(1, a.shape[0] - h + 1)), rng.integers(0, max(1, a.shape[1] - w + 1))
            a[y : y + h, x : x + w] = PAD
    lo, hi = np.clip(boxes[:, 1:3] - boxes[:, 3:] / 2, 0, 1), np.clip(boxes[:, 1:3] + boxes[:, 3:] / 2, 0, 1)
    seen = (hi - lo).prod(axis=1) >= MIN_VISIBILITY * np.maximum(boxes[:, 3:].prod(axis=1), 1e-12)
    out = np.concatenate([boxes[:, :1], np.round((lo + hi) / 2, 6), np.round(hi - lo, 6)], axis=1)
    return a, out[seen]
