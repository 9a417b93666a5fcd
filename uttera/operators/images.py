"""Frames: regions of interest, and preprocessing for text recognition as numpy kernels in Arrow batches.

Recognition itself is a seam: any function of images to strings. Interpolation follows the usual half-pixel-centre
definitions (cubic with a = -0.75, area for shrinking); it can differ by a grey level from other implementations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttera.config import ROI


def roi_table(spark) -> DataFrame:
    return spark.createDataFrame(list(ROI), "category string, region string, fx1 double, fy1 double, fx2 double, fy2 double")


def roi_boxes(sizes: DataFrame, roi: DataFrame) -> DataFrame:
    """Pixel boxes of every region for rows (category, width, height, ...), such as frames: the dimension has ten rows. Rows of other categories go."""
    box = sizes.join(F.broadcast(roi), "category")  # fixed size
    x, y = F.col("width"), F.col("height")
    return box.select(*[F.col(f"`{c}`") for c in sizes.columns], "region", F.floor(F.col("fx1") * x).alias("x1"), F.floor(F.col("fy1") * y).alias("y1"), (x - F.floor(F.col("fx2") * x)).alias("x2"), (y - F.floor(F.col("fy2") * y)).alias("y2"))


def crop(image: np.ndarray, box: tuple[int, int, int, int]) -> np.ndarray:
    x1, y1, x2, y2 = box
    return image[y1:y2, x1:x2]


def gray(image: np.ndarray) -> np.ndarray:
    """Luma of BGR pixels, rounded."""
    b, g, r = (image[..., k].astype(np.float64) for k in range(3))
    return np.floor(0.114 * b + 0.587 * g + 0.299 * r + 0.5).astype(np.uint8)


def swap_channels(image: np.ndarray) -> np.ndarray:
    return image[..., ::-1]


def contrast(image: np.ndarray, alpha: float) -> np.ndarray:
    """Scaled, absolute, rounded to even, saturated."""
    return np.clip(np.rint(np.abs(image.astype(np.float64) * alpha)), 0, 255).astype(np.uint8)


def gamma_table(gamma: float) -> np.ndarray:
    return ((np.arange(256) / 255.0) ** (1.0 / gamma) * 255).astype(np.uint8)


def gamma(image: np.ndarray, value: float) -> np.ndarray:
    return gamma_table(value)[image]


def sharpen(image: np.ndarray) -> np.ndarray:
    """Five times the pixel less its four neighbours; edges mirror without repeating the border."""
    p = np.pad(image.astype(np.int32), [(1, 1), (1, 1), *[(0, 0)] * (image.ndim - 2)], mode="reflect")
    return np.clip(5 * p[1:-1, 1:-1] - p[:-2, 1:-1] - p[2:, 1:-1] - p[1:-1, :-2] - p[1:-1, 2:], 0, 255).astype(np.uint8)


def _resize_axis(image: np.ndarray, axis: int, factor: float, area: bool) -> np.ndarray:
    n = image.shape[axis]
    m = max(1, round(n * factor))
    weights = np.zeros((m, n))
    for k in range(m):
        if area:
            a, b = k * n / m, (k + 1) * n / m
            for j in range(int(a), min(n, int(np.ceil(b)))):
                weights[k, j] += max(0.0, min(b, j + 1) - max(a, j)) / (b - a)
        else:
            at = (k + 0.5) * n / m - 0.5
            base = int(np.floor(at))
            for j in range(base - 1, base + 3):
                d, c = abs(at - j), -0.75
                w = (c + 2) * d**3 - (c + 3) * d**2 + 1 if d <= 1 else c * d**3 - 5 * c * d**2 + 8 * c * d - 4 * c
                weights[k, min(max(j, 0), n - 1)] += w
    moved = np.tensordot(weights, image.astype(np.float64), axes=(1, axis))
    return np.clip(np.rint(np.moveaxis(moved, 0, axis)), 0, 255).astype(np.uint8)


def resize(image: np.ndarray, fx: float, fy: float, area: bool = False) -> np.ndarray:
    for axis, f in ((1, fx), (0, fy)):
        if f != 1.0:
            image = _resize_axis(image, axis, f, area)
    return image


def blank_corner(image: np.ndarray) -> np.ndarray:
    """The icon's rectangle set to 0."""
    out, (h, w) = image.copy(), image.shape[:2]
    out[int(0.55 * h) : h - int(0.15 * h), int(0.88 * w) : w - int(0.08 * w)] = 0
    return out


def preprocess(image: np.ndarray, category: str, subtitles: bool = False) -> np.ndarray:
    """The chain of a category; an unknown one is an error."""
    if category in ("berseria", "zestiria"):
        return gamma(contrast(resize(swap_channels(image), 0.6, 1.0, area=True), 1.0), 0.8)
    if category not in ("xillia 1", "xillia 2", "vesperia"):
        raise ValueError(f"unknown category: {category}")
    out = sharpen(gamma(contrast(resize(gray(image), 1.0, 1.6), 2.7), 0.5 if category == "vesperia" else 0.1))
    return blank_corner(out) if subtitles and category != "vesperia" else out


def recognise(frames: DataFrame, ocr: Callable[[np.ndarray], str]) -> DataFrame:
    """(video_id, frame_idx, raw_speaker, raw_text) of frames (video_id, frame_idx, category, width, height, image as BGR bytes).

    Both regions are cropped before any pixel work; run it on matched frames only, after the as-of join.
    """
    boxes = {(c, r): (a, b, d, e) for c, r, a, b, d, e in ROI}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                image, texts = np.frombuffer(r.image, np.uint8).reshape(r.height, r.width, 3), []
                for region in ("speaker", "subtitle"):
                    x1, y1, x2, y2 = boxes[r.category, region]
                    box = (int(x1 * r.width), int(y1 * r.height), r.width - int(x2 * r.width), r.height - int(y2 * r.height))
                    texts.append(ocr(preprocess(crop(image, box), r.category, region == "subtitle")))
                out.append((r.video_id, r.frame_idx, *texts))
            yield pd.DataFrame(out, columns=["video_id", "frame_idx", "raw_speaker", "raw_text"])

    return frames.select("video_id", "frame_idx", "category", "width", "height", "image").mapInPandas(run, "video_id bigint, frame_idx bigint, raw_speaker string, raw_text string")


def known_category(c: Column) -> Column:
    return c.isin(*sorted({r[0] for r in ROI}))
