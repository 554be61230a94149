"""Pixel scores of thumbnails: Arrow-batched functions of Spark's image struct (height, width, nChannels, data).

Images of one shape are scored together. Where a score samples a border, it is a weight on every pixel: how
often the sample takes it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from vitrina.functions import rules

SIDE, LOW = 32, 8
BAND, EVEN = 3, 18.0
#: Pixels of one shape that are scored at once: some 60 bytes each, whatever the batch.
AT_ONCE = 1 << 18
#: Frequencies nearer to each other than this are equal: rounding parts them by some 1e-10, and they reach 1e5.
TIE = 1e-6


def pixels(data: list[bytes], h: int, w: int, n: int) -> np.ndarray:
    """Images x height x width x 3, blue first."""
    a = np.frombuffer(b"".join(data), np.uint8).reshape(len(data), h, w, n)
    return a[..., :3] if n >= 3 else np.repeat(a[..., :1], 3, 3)


def sampled(a: np.ndarray, weight: np.ndarray, white: float = rules.WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Of each image's weighted pixels the share that is white in every channel, and the mean deviation of its channels."""
    share = np.tensordot((a.min(axis=3) >= white).astype(int), weight, 2) / weight.sum()
    weight = weight / weight.sum()
    mean = np.einsum("nhwc,hw->nc", a, weight, dtype=float)
    square = np.einsum("nhwc,hw->nc", np.square(a, dtype=float), weight)
    return share, np.sqrt(np.maximum(square - mean**2, 0)).mean(axis=1)


def ends_and_middles(h: int, w: int) -> np.ndarray:
    """Weights of the corners and the middles of the sides; on a side of one or two pixels they coincide and add up."""
    rows, columns = (np.bincount([0, n // 2, n - 1], minlength=n) for n in (h, w))
    weight = np.outer(rows, columns)
    inner = [0 < n // 2 < n - 1 for n in (h, w)]
    if all(inner):
        weight[h // 2, w // 2] = 0
    return weight


def border(h: int, w: int, band: int = BAND) -> np.ndarray:
    """Weights of bands along the four sides; corners lie in two of them."""
    rows, columns = ((np.arange(n) < band).astype(int) + (np.arange(n) >= n - band) for n in (h, w))
    return rows[:, None] + columns[None, :]


def _shrink(n: int) -> np.ndarray:
    """Weights by which n pixels in a row become SIDE, each the mean of what it covers."""
    edge = np.arange(SIDE + 1) * n / SIDE
    low, high = np.maximum(edge[:-1, None], np.arange(n)), np.minimum(edge[1:, None], np.arange(n) + 1)
    cover = np.clip(high - low, 0, None)
    return cover / cover.sum(axis=1, keepdims=True)


_COSINES = np.cos(np.pi * np.arange(SIDE)[:, None] * (2 * np.arange(SIDE) + 1) / (2 * SIDE))


def perceptual_hashes(a: np.ndarray) -> list[int]:
    """64 bits an image: which low frequencies of the grey image lie above their median. Other resizers differ in a few."""
    grey = a @ np.array([0.114, 0.587, 0.299])
    rows, columns = (_COSINES[:LOW] @ _shrink(n) for n in a.shape[1:3])
    low = (rows @ grey @ columns.T).reshape(len(a), -1)
    bits = np.packbits(low - np.median(low, axis=1, keepdims=True) > TIE, axis=1)
    return [int.from_bytes(x.tobytes(), "big", signed=True) for x in bits]


@pandas_udf(T.StructType([T.StructField("bg_score", T.DoubleType()), T.StructField("phash", T.LongType()), T.StructField("bg_white", T.DoubleType()), T.StructField("bg_mono", T.BooleanType())]))
def _scores(image: pd.DataFrame) -> pd.DataFrame:
    size = image[["height", "width", "nChannels"]].fillna(0).astype(int)
    lengths = image["data"].map(lambda d: len(d) if d is not None else 0)
    whole = image[(lengths > 0) & (size.prod(axis=1) == lengths)]
    out = pd.DataFrame({"bg_score": 0.0, "phash": pd.array([None] * len(image), "Int64"), "bg_white": np.nan, "bg_mono": pd.array([None] * len(image), "boolean")}, index=image.index)
    for (h, w, n), every in size.loc[whole.index].groupby(["height", "width", "nChannels"]).groups.items():
        step, ends, sides = max(1, AT_ONCE // (h * w)), ends_and_middles(h, w), border(h, w)
        for rows in (every[i : i + step] for i in range(0, len(every), step)):
            a = pixels(image.loc[rows, "data"].tolist(), h, w, n)
            white, uneven = sampled(a, ends)
            out.loc[rows, "bg_score"] = [round(float(x), 3) for x in 0.7 * white + 0.3 * (1 - np.minimum(uneven / 128, 1))]
            white, uneven = sampled(a, sides)
            out.loc[rows, "bg_white"] = [round(float(x), 2) for x in white]
            out.loc[rows, "bg_mono"] = uneven < EVEN
            out.loc[rows, "phash"] = perceptual_hashes(a)
    return out


def image_scores(image: str | Column) -> Column:
    """bg_score (0 for a missing image), phash, bg_white and bg_mono (null for one)."""
    i = F.col(image) if isinstance(image, str) else image
    return _scores(F.struct(i["height"].alias("height"), i["width"].alias("width"), i["nChannels"].alias("nChannels"), i["data"].alias("data")))
