"""Substring dedup: repeated windows of tokens, found by Rabin-Karp hashes and merged into removal intervals.

A window is a fixed number of consecutive words of one document. It is a repeat if a document with a smaller id has the
same words in a row; every word that a repeat covers is removed. Windows are judged on the input.

Every window's hash is computed, but only windows that can repeat are sent through the shuffle: each window has an
*anchor*, the least hash among the short word runs inside it. Equal windows have equal anchors, and neighbouring windows
mostly share one, so anchors are a few percent of the windows. Anchors are counted in Spark first; a fixed-size bitmap of
those that occur in more than one document tells tasks which windows to send. No window is lost: the bitmap only ever lets
too many through, and the exact comparison is the grouping of
84-bit window hashes. A second bitmap, of the rows with repeats, lets the texts of all other rows stay where they are.

Defined cases: a null text has no words; texts shorter than a window keep everything; rows with equal ids do not repeat
each other; rows without an id keep everything and are nobody's original; an empty table gives an empty one; other
columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..runtime import materialize
from . import packed
from .bitmaps import BITS, bitmap, contains

WINDOW = 50
ANCHOR = 25


def _anchors(words: np.ndarray, starts: np.ndarray, window: int, run: int) -> np.ndarray:
    """Anchor of each window in ``starts``: the least hash of the ``run``-word runs inside the window."""
    least = packed.window_hashes(words, run, salt=1)
    span, left = window - run + 1, 1
    while 2 * left <= span:  # minima over powers of two, then over two overlapping ones
        least = np.minimum(least[:-left], least[left:])
        left *= 2
    return np.minimum(least[starts], least[starts + span - left])


def windows(data: np.ndarray, offsets: np.ndarray, window: int, run: int):
    """``(start, row, anchor, words)`` of all windows of a chunk; starts are word numbers of the chunk."""
    starts, ends, at = packed.word_spans(data, offsets, packed.VISIBLE)
    hashes = packed.span_hashes(data, starts, ends)
    bounds = packed.row_starts(at, len(offsets) - 1)
    first = packed.whole_windows(bounds, window)
    anchor = _anchors(hashes, first, window, run) if len(first) else np.zeros(0, np.uint64)
    return first, at[first] if len(first) else first, anchor, hashes, bounds


def _anchor_rows(window: int, run: int):
    def tasks(batches):
        for batch in batches:
            keys = batch.column(1)
            for rows, data, offsets in packed.chunks(batch.column(0)):
                _, row, anchor, _, _ = windows(data, offsets, window, run)
                if not len(row):
                    continue
                change = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])])
                row, anchor = row[change], anchor[change]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(row + rows.start)), pa.array(packed.signed(anchor))], ["id", "anchor"])

    return tasks


def _window_rows(window: int, run: int, repeated: np.ndarray):
    def tasks(batches):
        for batch in batches:
            keys, marks = batch.column(1), batch.column(2)
            for rows, data, offsets in packed.chunks(batch.column(0)):
                first, row, anchor, words, bounds = windows(data, offsets, window, run)
                hit = np.flatnonzero(contains(repeated, anchor)) if len(first) else first
                if not len(hit):
                    continue
                whole = packed.window_hashes(words, window)[first[hit]]
                check = packed.mix(anchor[hit] ^ packed.window_hashes(words, window, salt=2)[first[hit]]) >> np.uint64(44)
                mark = marks.to_numpy()[row[hit] + rows.start].view(np.uint64) & np.uint64(0xFFFF)
                place = (first[hit] - bounds[row[hit]]).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(row[hit] + rows.start)), pa.array(packed.signed((mark << np.uint64(40)) | place)), pa.array(packed.signed(whole)), pa.array(check.astype(np.int32))],
                    ["id", "place", "hash", "check"],
                )

    return tasks


def _with_mark(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows with a 16-bit mark of their text, which tells rows with equal ids apart."""
    return docs.select(F.col(text).alias("text"), F.col(key).alias("id"), F.xxhash64(F.col(text)).bitwiseAND(F.lit(0xFFFF)).alias("mark"))


def repeated_windows(docs: DataFrame, key: str, text: str, window: int = WINDOW, run: int = ANCHOR, bits: int = BITS) -> DataFrame:
    """``(id, mark, starts)``: per row with repeats the word numbers at which they start."""
    kind = docs.select(key).schema[0].dataType.simpleString()
    rows = _with_mark(docs, key, text).where(F.col("id").isNotNull())
    anchors = rows.mapInArrow(_anchor_rows(window, run), f"id {kind}, anchor long")
    shared = anchors.groupBy("anchor").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    repeated = bitmap(shared, F.col("anchor"), bits)
    found = rows.mapInArrow(_window_rows(window, run, repeated), f"id {kind}, place long, hash long, check int")
    found = materialize(found, "windows")
    origin = found.groupBy("hash", "check").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    origin = materialize(origin.drop("most"), "origins")  # stored, so that a hot window's rows can be split in the join
    again = found.join(origin, ["hash", "check"]).where("id > least")
    marked = again.select("id", F.shiftright("place", 40).alias("mark"), F.expr("cast(place & 1099511627775 as int)").alias("at"))
    return materialize(marked.groupBy("id", "mark").agg(F.sort_array(F.collect_set("at")).alias("starts")), "repeats")


def intervals(starts: np.ndarray, window: int) -> np.ndarray:
    """Maximal ``[first, end)`` word intervals covered by windows at the sorted ``starts``."""
    if not len(starts):
        return np.zeros((0, 2), dtype=np.int64)
    new = np.flatnonzero(np.r_[True, starts[1:] > starts[:-1] + window])
    last = np.r_[new[1:] - 1, len(starts) - 1]
    return np.column_stack([starts[new], starts[last] + window]).astype(np.int64)


def _remove(window: int, key_type):
    def tasks(batches):
        for batch in batches:
            texts, keys, found = batch.columns
            for rows, data, offsets in packed.chunks(texts):
                starts, ends, at = packed.word_spans(data, offsets, packed.VISIBLE)
                bounds = packed.row_starts(at, len(offsets) - 1)
                raw = data.tobytes()
                kept, counts, removed, cut = [], [], [], []
                for n in range(len(offsets) - 1):
                    s, e = starts[bounds[n]:bounds[n + 1]], ends[bounds[n]:bounds[n + 1]]
                    where = found[rows.start + n]
                    spans = intervals(np.asarray(where.values) if where.is_valid else np.zeros(0, np.int64), window)
                    keep = np.ones(len(s), dtype=bool)
                    for first, last in spans:
                        keep[first:last] = False
                    kept.append(b" ".join(raw[x:y] for x, y in zip(s[keep].tolist(), e[keep].tolist())))
                    counts.append(len(s))
                    removed.append(int(len(s) - keep.sum()))
                    cut.append(spans.ravel().tolist())
                size = len(kept)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(rows.start, size), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(cut, pa.list_(pa.int64()))],
                    ["id", "n_words", "n_removed", "kept_sha256", "kept", "cuts"],
                )

    return tasks


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, run: int = ANCHOR) -> DataFrame:
    """``(key, n_words, n_removed, kept_sha256, kept, cuts)``: the kept words joined by one space, their digest, and the removed
    intervals as a flat list of first word and end."""
    if not 1 <= run <= window:
        raise ValueError("an anchor run has between one word and a window's words")
    starts = repeated_windows(docs, key, text, window, run)
    known = bitmap(starts, F.xxhash64("id"))

    @F.arrow_udf(T.BooleanType())
    def touched(hashes: pa.Array) -> pa.Array:
        return pa.array(contains(known, hashes.to_numpy()))

    marked = _with_mark(docs, key, text).withColumn("touched", touched(F.xxhash64("id")))
    rest = marked.where(~F.col("touched")).select("text", "id", F.lit(None).cast("array<int>").alias("starts"))
    rows = marked.where("touched").join(starts, ["id", "mark"], "left").select("text", "id", "starts").union(rest)
    kind = docs.select(key).schema[0].dataType
    out = rows.mapInArrow(
        _remove(window, to_arrow_type(kind)),
        f"id {kind.simpleString()}, n_words long, n_removed long, kept_sha256 string, kept string, cuts array<long>",
    )
    return out.withColumnRenamed("id", key)
