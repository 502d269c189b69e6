"""Fixed-size bitmaps of hashes, built in Spark and sent to tasks.

A bitmap tells tasks which rows can matter to a later exact join: it never loses a row, only lets some through that the
join then drops. Its size is a parameter and does not grow with the data; fuller bitmaps let more rows through.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 25


def bitmap(df: DataFrame, hashes: Column, bits: int = BITS) -> np.ndarray:
    """Bitmap of ``bits`` (a power of two) with the bit ``hash mod bits`` of every row set; at most ``bits / 64`` rows are collected."""
    place = hashes.bitwiseAND(F.lit(bits - 1))
    words = df.select(place.alias("bit")).select(
        F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("mask")
    )
    table = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[table["word"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return out


def contains(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash's bit is set."""
    bit = hashes.view(np.uint64) & np.uint64(64 * len(words) - 1)
    return (words[(bit >> np.uint64(6)).view(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) != 0
