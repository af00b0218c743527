"""Pixel queries over images made from ``embeddings``: 64 values as 8 x 8 grey pixels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from prismset.operators import pixels as X
from prismset.session import table

QUERIES: dict = {}
ORACLES: dict = {}

#: Grey values of each vector, in rows of eight.
_GREY = "e AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda v: greatest(0.0::DOUBLE, least(255.0::DOUBLE, round_even((v + 0.5::DOUBLE) * 255::DOUBLE, 0)))) AS g FROM embeddings)"
#: Bits as a signed number: the first is the highest, and 2 ** 63 is taken off.
_SIGNED = "CAST(list_sum(list_transform(range(1, 65), lambda k: CASE WHEN {bit} THEN CAST(1 AS HUGEINT) << (64 - k) ELSE CAST(0 AS HUGEINT) END)) - (CAST(1 AS HUGEINT) << 63) AS BIGINT)"


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _image(v: np.ndarray, width: int = 8) -> np.ndarray:
    g = np.clip(np.rint((np.asarray(v, float) + 0.5) * 255), 0, 255).astype(np.uint8).reshape(-1, width, 1)
    return np.repeat(g, 3, axis=2)


def _each(spark: SparkSession, d: str, f: Callable[[int, np.ndarray], tuple], schema: str, width: int = 8) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(i, *f(i, _image(v, width))) for i, v in zip(b["vec_id"], b["embedding"], strict=True)], columns=names)

    return table(spark, d, "embeddings").select("vec_id", "embedding").mapInPandas(run, schema)


_AT = "g[8 * ({y}) + ({x}) + 1]"
_Y, _X = "k // 8", "k % 8"
_MIRROR = lambda v: f"CASE WHEN {v} < 0 THEN 1 WHEN {v} > 7 THEN 6 ELSE {v} END"
_LAPLACE = " + ".join(_AT.format(y=_MIRROR(f"{_Y} + {dy}"), x=_MIRROR(f"{_X} + {dx}")) for dy, dx in ((-1, 0), (1, 0), (0, -1), (0, 1))) + " - 4 * g[k + 1]"


@query(f"""WITH {_GREY}, l AS (SELECT vec_id, list_transform(range(0, 64), lambda k: {_LAPLACE}) AS l FROM e)
SELECT vec_id, (64 * list_sum(list_transform(l, lambda v: v * v)) - list_sum(l) * list_sum(l)) / 4096 AS variance FROM l""")
def blur_score(spark: SparkSession, d: str) -> DataFrame:
    return _each(spark, d, lambda _, a: (X.blur_variance(a),), "vec_id long, variance double")


_WIDER = "greatest(0.0::DOUBLE, least(7.0::DOUBLE, (j + 0.5::DOUBLE) * 8 / 9 - 0.5::DOUBLE))"


@query(f"""WITH {_GREY},
c AS (SELECT list(p ORDER BY j) AS cols FROM (SELECT j, {{'low': CAST(floor({_WIDER}) AS INT), 'part': {_WIDER} - floor({_WIDER})}} AS p FROM range(0, 9) r(j))),
s AS (SELECT vec_id, g, list_transform(range(0, 72), lambda k: g[8 * (k // 9) + cols[k % 9 + 1].low + 1] * (1 - cols[k % 9 + 1].part) + g[8 * (k // 9) + least(7, cols[k % 9 + 1].low + 1) + 1] * cols[k % 9 + 1].part) AS w FROM e, c)
SELECT vec_id, {_SIGNED.format(bit='w[9 * ((k - 1) // 8) + (k - 1) % 8 + 2] > w[9 * ((k - 1) // 8) + (k - 1) % 8 + 1]')} AS dhash,
  {_SIGNED.format(bit='g[k] > list_sum(g) / 64')} AS ahash FROM s""")
def plain_hashes(spark: SparkSession, d: str) -> DataFrame:
    """Gradient and mean hashes."""
    return _each(spark, d, lambda _, a: tuple(X.perceptual_hash(a, m) for m in ("dhash", "ahash")), "vec_id long, dhash long, ahash long")


@query(None)
def phash_images(spark: SparkSession, d: str) -> DataFrame:
    """The cosine-transform hash; its definition is tested on its own."""
    return _each(spark, d, lambda _, a: (X.perceptual_hash(a, "phash"),), "vec_id long, phash long")


_UP = "greatest(0.0::DOUBLE, least({top}, ({v} + 0.5::DOUBLE) / 2 - 0.5::DOUBLE))"
_ROW, _COL = _UP.format(top="3.0::DOUBLE", v="y"), _UP.format(top="15.0::DOUBLE", v="x")
_PX = "g[16 * CAST({y} AS INT) + CAST({x} AS INT) + 1]"


@query(f"""WITH {_GREY},
p AS (SELECT y, x, floor({_ROW}) AS y0, floor({_COL}) AS x0, {_ROW} - floor({_ROW}) AS fy, {_COL} - floor({_COL}) AS fx FROM range(0, 8) a(y), range(0, 32) b(x)),
q AS (SELECT vec_id, y, x, round_even(({_PX.format(y='y0', x='x0')} * (1 - fx) + {_PX.format(y='y0', x='least(15, x0 + 1)')} * fx) * (1 - fy)
  + ({_PX.format(y='least(3, y0 + 1)', x='x0')} * (1 - fx) + {_PX.format(y='least(3, y0 + 1)', x='least(15, x0 + 1)')} * fx) * fy, 0) AS v FROM e, p)
SELECT vec_id, CAST(sum(v * ((12 + y) * 32 + x + 1)) + 114 * (1024 * 1025 // 2 - sum((12 + y) * 32 + x + 1)) AS BIGINT) AS weighed FROM q GROUP BY vec_id""")
def letterbox_pixels(spark: SparkSession, d: str) -> DataFrame:
    """All pixels of the letterboxed 4 x 16 image, each weighed by its place."""
    weights = np.arange(1, 32 * 32 + 1)
    return _each(spark, d, lambda _, a: (int((X.letterbox(a, 32)[:, :, 0].ravel().astype(np.int64) * weights).sum()),), "vec_id long, weighed long", 16)


@query(None)
def augment_pixels(spark: SparkSession, d: str) -> DataFrame:
    def f(i: int, a: np.ndarray) -> tuple:
        out, boxes = X.augment(a, np.array([[0, 0.5, 0.5, 0.5, 0.5]]), {}, str(i))
        return float(out.mean()), len(boxes)

    return _each(spark, d, f, "vec_id long, mean double, boxes long")
