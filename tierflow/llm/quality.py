"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each document is described by statistics of its bytes, words and lines, transformed so that they are roughly symmetric.
Each class is a normal density: its mean and a covariance shrunk towards the pooled one and towards the pooled diagonal.
The score is the logistic of the difference of the two log densities (Mahalanobis distances through cached Cholesky
factors, log determinants, class shares). Statistics are cut off at a distance from the pooled mean, so that no single
one of them decides.

Fitting reads all labelled rows; what reaches the driver is one sum per class and pair of statistics, a fixed number.

Defined cases: a null text counts as an empty one; empty texts are scored like any other; rows without a label (or a
label other than 0 and 1) take no part in fitting; repeated labels count one by one; without rows of one class every
score is the share of class 1 (0.5 without any row); other columns are kept and never looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import packed

NAMES = (
    "words", "word_length", "word_length_spread", "distinct_words", "short_words", "capital_words", "odd_endings", "longest_word",
    "uppercase", "digits", "stops", "bars", "symbols", "foreign", "lines", "distinct_lines", "line_length", "bytes",
)
THRESHOLD = 0.3
#: Rates count as if a text went on for so long without the thing counted, so that one number in a short text is not a high rate.
PRIOR_BYTES, PRIOR_WORDS, PRIOR_LINES = 100, 10, 3

_CLASSES = np.zeros(256, dtype=np.int64)
for _class, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,", b"|", b"!\"#$%&'()*+-/:;<=>?@[\\]^_`{}~", bytes(range(128, 256)), b"\n"), 1):
    _CLASSES[np.frombuffer(_bytes, dtype=np.uint8)] = _class
_ODD_END = np.zeros(256, dtype=bool)
_ODD_END[np.frombuffer(b"!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~", dtype=np.uint8)] = True
_NOT_BREAK = np.ones(256, dtype=bool)
_NOT_BREAK[ord("\n")] = False


def _distinct_share(hashes: np.ndarray, rows: np.ndarray, counts: np.ndarray, prior: int) -> np.ndarray:
    """Distinct values per row divided by the row's number of values, drawn towards 1 where there are few."""
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return (np.bincount(r[new], minlength=len(counts)) + prior) / (counts + prior)


def _chunk_statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    kinds = np.bincount(row * 8 + _CLASSES[data], minlength=8 * n).reshape(n, 8)
    size = np.diff(offsets)
    starts, ends, at = packed.word_spans(data, offsets, packed.VISIBLE)
    length = (ends - starts).astype(float)
    words = np.bincount(at, minlength=n)
    per_word = np.maximum(words, 1)
    mean = np.bincount(at, length, n) / per_word
    square = np.bincount(at, length**2, n) / per_word
    longest = np.zeros(n)
    np.maximum.at(longest, at, length)
    line_starts, line_ends, line_at = packed.word_spans(data, offsets, _NOT_BREAK)
    lines = np.bincount(line_at, minlength=n)
    line_hashes = packed.span_hashes(data, line_starts, line_ends)
    rate = np.sqrt(kinds / (size + PRIOR_BYTES)[:, None])

    def share(flags):
        return np.bincount(at, flags, n) / (words + PRIOR_WORDS)

    columns = (
        np.log1p(words), np.log1p(mean), np.log1p(np.sqrt(np.maximum(square - mean**2, 0))),
        _distinct_share(packed.span_hashes(data, starts, ends), at, words, PRIOR_WORDS), share(length <= 3),
        np.sqrt(share(_CLASSES[data[starts]] == 1)), np.sqrt(share(_ODD_END[data[ends - 1]])), np.log1p(longest),
        rate[:, 1], rate[:, 2], rate[:, 3], rate[:, 4], rate[:, 5], rate[:, 6], rate[:, 7],
        _distinct_share(line_hashes, line_at, lines, PRIOR_LINES), np.log1p(np.bincount(line_at, (line_ends - line_starts).astype(float), n) / np.maximum(lines, 1)),
        np.log1p(size),
    )
    return np.column_stack(columns)


def statistics_of(texts: pa.Array) -> np.ndarray:
    """The statistics ``NAMES`` of each text."""
    parts = [_chunk_statistics(data, offsets) for _, data, offsets in packed.chunks(texts)]
    return np.vstack(parts) if parts else np.zeros((0, len(NAMES)))


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def statistics(texts: pa.Array) -> pa.Array:
    """The statistics of a text column."""
    values = statistics_of(texts)
    return packed.list_rows(values.ravel(), np.arange(len(values) + 1) * len(NAMES))


@dataclass(frozen=True)
class Discriminant:
    """The fitted densities: pooled centre and spread, and per class mean, inverse Cholesky factor and log constant."""

    centre: np.ndarray
    spread: np.ndarray
    means: tuple
    inverse_factors: tuple
    constants: tuple
    share: float
    cut: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), self.share)
        z = np.clip((x - self.centre) / self.spread, -self.cut, self.cut)
        log = [
            constant - 0.5 * (((z - mean) @ factor.T) ** 2).sum(axis=1)
            for mean, factor, constant in zip(self.means, self.inverse_factors, self.constants)
        ]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))

    def score(self, features: Column) -> Column:
        """Score of a statistics column: 0 to 1, higher where class 1 is likelier."""
        model = self

        @F.arrow_udf(T.DoubleType())
        def score_of(rows: pa.Array) -> pa.Array:
            flat = rows.flatten().to_numpy(zero_copy_only=False)
            return pa.array(model.scores(flat.reshape(len(rows), -1)) if len(rows) else np.zeros(0))

        return score_of(features)


def _class_sums(rows: DataFrame, features: str, label: str, shift: np.ndarray, spread: np.ndarray, cut: float) -> dict[int, np.ndarray]:
    """Per class the sums of 1, z and z zᵀ over all rows, z the cut statistics; one partial sum per task goes through the shuffle."""
    width = len(shift)

    def partial(batches):
        sums = np.zeros((2, 1 + width + width * width))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            z = np.clip((x - shift) / spread, -cut, cut)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for c in (0, 1):
                zc = z[y == c]
                sums[c, 0] += len(zc)
                sums[c, 1:1 + width] += zc.sum(axis=0)
                sums[c, 1 + width:] += (zc.T @ zc).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(sums.tolist(), pa.list_(pa.float64()))], ["label", "sums"])

    parts = rows.select(features, F.col(label).cast("int")).mapInArrow(partial, "label int, sums array<double>")
    total = parts.select("label", F.posexplode("sums").alias("at", "value")).groupBy("label", "at").agg(F.sum("value").alias("value"))
    out = {0: np.zeros(1 + width + width * width), 1: np.zeros(1 + width + width * width)}
    for r in total.toPandas().itertuples(index=False):
        out[r.label][r.at] = r.value
    return out


def fit(
    rows: DataFrame, features: str = "features", label: str = "quality", shrink: float = 0.1, ridge: float = 0.1, cut: float = 4.0
) -> Discriminant:
    """Fit on rows with statistics and a 0/1 label; ``shrink`` weighs the pooled covariance, ``ridge`` the pooled diagonal.

    Two passes: pooled centre and spread, then the class sums of the statistics in units of that spread, cut at ``cut``.
    """
    width = len(NAMES)
    rows = rows.where(F.col(label).isin(0, 1) & F.col(features).isNotNull())
    raw = sum(_class_sums(rows, features, label, np.zeros(width), np.ones(width), np.inf).values())
    n = max(raw[0], 1.0)
    centre = raw[1:1 + width] / n
    spread = np.sqrt(np.maximum(np.diag(raw[1 + width:].reshape(width, width)) / n - centre**2, 1e-8))
    sums = _class_sums(rows, features, label, centre, spread, cut)
    counts = [sums[c][0] for c in (0, 1)]
    share = float(counts[1] / sum(counts)) if sum(counts) else 0.5
    if not all(counts):
        return Discriminant(centre, spread, (), (), (), share, cut)
    means = [sums[c][1:1 + width] / counts[c] for c in (0, 1)]
    covs = [sums[c][1 + width:].reshape(width, width) / counts[c] - np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = (counts[0] * covs[0] + counts[1] * covs[1]) / sum(counts)
    diagonal = np.diag(np.maximum(np.diag(pooled), 1e-3))
    factors, constants = [], []
    for c in (0, 1):
        factor = np.linalg.cholesky((1 - shrink - ridge) * covs[c] + shrink * pooled + ridge * diagonal)
        factors.append(np.linalg.inv(factor))
        constants.append(float(np.log(counts[c] / sum(counts)) - np.log(np.diag(factor)).sum()))
    return Discriminant(centre, spread, tuple(means), tuple(factors), tuple(constants), share, cut)


def held_out(key: Column, parts: int) -> Column:
    """Whether a row is kept from training: crc32 of the key as text is divisible by ``parts``."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == 0, F.lit(False))


def train(features: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", folds: int = 5) -> Discriminant:
    """Fit on the labelled rows of ``features`` (key, features) that are not held out."""
    known = labels.select(F.col(key), F.col(label)).where(F.col(label).isNotNull() & ~held_out(F.col(key), folds))
    return fit(features.select(key, "features").join(known, key), label=label)


def accuracy(scored: pd.DataFrame, threshold: float = THRESHOLD) -> float:
    """Share of rows (score, quality) on the right side of the threshold."""
    return float(((scored["score"] >= threshold).astype(int) == scored["quality"]).mean())
