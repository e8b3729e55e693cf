"""Sharpness and perceptual hash of decoded images, one Arrow batch at a time.

Pixels go in and two numbers come out, so image bytes are never shuffled.
"""

from __future__ import annotations

from functools import lru_cache
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

# Integer weights of the two grey conversions (15- and 16-bit), and the
# size of the image and of its low band used for the hash.
SHARPNESS_WEIGHTS = {"blue": 3735, "green": 19235, "red": 9798}
HASH_WEIGHTS = {"blue": 7471, "green": 38470, "red": 19595}
HASH_IMAGE_SIDE = 32
HASH_SIDE = 8

FEATURES = T.StructType([
    T.StructField("blur_score", T.DoubleType()),
    T.StructField("image_hash", T.LongType()),
])


def bgr_pixels(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Height x width x 3 array; one channel is repeated, a fourth is dropped."""
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    return np.repeat(pixels, 3, axis=2) if channels == 1 else pixels[:, :, :3]


def _grey(bgr: np.ndarray, weights: dict[str, int], bits: int) -> np.ndarray:
    factors = np.array([weights["blue"], weights["green"], weights["red"]], dtype=np.int64)
    return (bgr.astype(np.int64) @ factors + (1 << (bits - 1))) >> bits


def sharpness(bgr: np.ndarray) -> float:
    """Population variance of the 3x3 Laplacian; the border is mirrored without repeating it."""
    grey = _grey(bgr, SHARPNESS_WEIGHTS, 15)
    modes = [("reflect" if n > 1 else "edge") for n in grey.shape]
    p = np.pad(grey, ((1, 1), (0, 0)), mode=modes[0])
    p = np.pad(p, ((0, 0), (1, 1)), mode=modes[1])
    lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * grey
    n, total, squares = lap.size, int(lap.sum()), int((lap * lap).sum())
    return (n * squares - total * total) / (n * n)


@lru_cache(maxsize=256)
def _lanczos_rows(size: int, wanted: int) -> np.ndarray:
    """Weights (wanted x size) of a Lanczos reduction, in 22-bit fixed point."""
    scale = size / wanted
    stretch = max(scale, 1.0)
    rows = np.zeros((wanted, size), dtype=np.int64)
    for i in range(wanted):
        centre = (i + 0.5) * scale
        first = max(int(centre - 3 * stretch + 0.5), 0)
        last = min(int(centre + 3 * stretch + 0.5), size)
        x = (np.arange(first, last) - centre + 0.5) / stretch
        w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
        w = w / w.sum() * (1 << 22)
        rows[i, first:last] = np.trunc(w + np.copysign(0.5, w)).astype(np.int64)
    return rows


def _reduced(grey: np.ndarray, side: int) -> np.ndarray:
    half = 1 << 21

    def settle(v: np.ndarray) -> np.ndarray:
        return np.clip((v + half) >> 22, 0, 255)

    across = settle(grey @ _lanczos_rows(grey.shape[1], side).T)
    return settle(_lanczos_rows(grey.shape[0], side) @ across)


@lru_cache
def _cosines(side: int) -> np.ndarray:
    k, n = np.arange(side)[:, None], np.arange(side)[None, :]
    return 2 * np.cos(np.pi * k * (2 * n + 1) / (2 * side))


def perceptual_hash(bgr: np.ndarray) -> int:
    """64 bits, one per low-frequency cosine term above their median, as signed integer."""
    small = _reduced(_grey(bgr, HASH_WEIGHTS, 16), HASH_IMAGE_SIDE).astype(np.float64)
    basis = _cosines(HASH_IMAGE_SIDE)[:HASH_SIDE]
    low = basis @ small @ basis.T
    bits = (low > np.median(low)).reshape(-1)
    return int(np.packbits(bits).view(">i8")[0])


@F.pandas_udf(FEATURES)
def image_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for image in batch.itertuples(index=False):
            if image.height is None or image.height <= 0:
                out.append((None, None))
                continue
            bgr = bgr_pixels(image.data, image.height, image.width, image.nChannels)
            out.append((sharpness(bgr), perceptual_hash(bgr)))
        yield pd.DataFrame(
            {
                "blur_score": pd.Series([b for b, _ in out], dtype="float64"),
                "image_hash": pd.Series([h for _, h in out], dtype="Int64"),
            }
        )


def with_features(images: DataFrame) -> DataFrame:
    """Size, sharpness and hash per image; the pixels end here."""
    columns = [c for c in images.columns if c != "image"]
    return images.select(
        *columns, F.col("image.width").alias("width"), F.col("image.height").alias("height"),
        image_features("image").alias("_f"),
    ).select(*columns, "width", "height", "_f.*")
