"""Language-model scores by context-tree weighting over bytes.

The model: a text is its bytes in lower case (A-Z only) between ``DEPTH`` start marks and one end mark, all 0xFF, a byte
that UTF-8 never has. Each byte is decomposed into 8 binary decisions. For every decision there is a context tree over
the preceding bytes, most recent first, of depth ``DEPTH``; each node has the Krichevsky-Trofimov probability of the
decisions seen in its context, and weighs it one to one against the product of its children. Learnt from the training
rows and then left as it is, the tree gives each decision a probability that mixes the estimates of all depths, and a
text the product over its bytes and its end. Probabilities of all possible texts add up to 1.

How it runs: (1) tasks count byte grams (context and next byte) and words of their rows; Spark adds them up. (2) Grams
are grouped by their two most recent context bytes; a subtree of depth 2 and below is complete in its partition, and the
levels above it are a fixed 256 x 256 table. Every gram of the corpus, trained or only to be scored, gets its log
probability. (3) Scoring looks grams and words up in tables of the most frequent ones, whose size is bounded by
``head_grams`` and ``head_words``; what is missing there is counted per text and joined with the other entries.

Defined cases: a null text counts as an empty one (one end mark); empty tables give empty ones; repeated rows count one
by one; a null id belongs to the training rows; without training rows every decision has probability 1/2; other columns
are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..runtime import materialize
from . import packed
from .quality import held_out

DEPTH = 5
MARK = 0xFF
GRAM, WORD = 0, 1
END_WORD = np.uint64(0)
SMOOTHING = 0.1

_U = np.uint64
_COUNT_BUFFER = 1 << 20


# ---------------------------------------------------------------------------------------------------- grams of texts

def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(codes, bounds)``: one 48-bit code per byte and end of each row. From the top: most recent context byte, older ones, next byte."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    gap = DEPTH + 1
    row = np.repeat(np.arange(n), size)
    stream = np.full(len(data) + gap * n, MARK, dtype=_U)
    stream[np.arange(len(data)) + gap * row + DEPTH] = data
    codes = np.zeros(len(stream) - DEPTH, dtype=_U)
    for back in range(DEPTH + 1):
        shift = _U(0 if back == 0 else 8 * (DEPTH + 1 - back))
        codes |= stream[DEPTH - back:len(stream) - back] << shift
    bounds = offsets + np.arange(n + 1)
    keep = np.arange(bounds[-1]) + np.repeat(np.arange(n) * DEPTH, size + 1)
    return codes[keep], bounds


def _row_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word and of the end of each row."""
    starts, ends, at = packed.word_spans(data, offsets, packed.VISIBLE)
    n = len(offsets) - 1
    hashes = np.concatenate([packed.span_hashes(data, starts, ends), np.full(n, END_WORD)])
    return hashes, np.concatenate([at, np.arange(n)])


class _Counter:
    """Counts of 64-bit keys in training rows and in all rows, kept sorted and merged as they come."""

    def __init__(self):
        self.keys, self.trained, self.all = np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting, self.size = [], 0

    def add(self, keys: np.ndarray, trained: np.ndarray) -> None:
        self.waiting.append((keys[trained], keys[~trained]))
        self.size += len(keys)
        if self.size >= _COUNT_BUFFER:
            self.merge()

    def merge(self) -> None:
        if not self.waiting:
            return
        parts = [(self.keys, self.trained, self.all)]
        for k, trained in ((0, True), (1, False)):
            keys, counts = np.unique(np.concatenate([w[k] for w in self.waiting]), return_counts=True)
            parts.append((keys, counts if trained else np.zeros_like(counts), counts))
        keys = np.concatenate([p[0] for p in parts])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        sums = [np.add.reduceat(np.concatenate([p[k] for p in parts])[order], first) if len(keys) else np.zeros(0, np.int64) for k in (1, 2)]
        self.keys, self.trained, self.all = keys[first], *sums
        self.waiting, self.size = [], 0

    def batches(self, kind: int):
        self.merge()
        for at in range(0, len(self.keys), 1 << 17):
            part = slice(at, at + (1 << 17))
            keys = packed.signed(self.keys[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(self.trained[part]), pa.array(self.all[part])],
                ["kind", "key", "trained", "n"],
            )


def _count(batches):
    counters = {GRAM: _Counter(), WORD: _Counter()}
    for batch in batches:
        trained = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for rows, data, offsets in packed.chunks(batch.column(0), lower=True):
            here = trained[rows]
            codes, bounds = grams(data, offsets)
            counters[GRAM].add(codes, np.repeat(here, np.diff(bounds)))
            words, at = _row_words(data, offsets)
            counters[WORD].add(words, here[at])
    for kind, counter in counters.items():
        yield from counter.batches(kind)


def corpus_counts(rows: DataFrame) -> DataFrame:
    """``(kind, key, trained, n)`` of all grams and words in rows (text, trained)."""
    parts = rows.select("text", "trained").mapInArrow(_count, "kind int, key long, trained long, n long")
    return parts.groupBy("kind", "key").agg(F.sum("trained").alias("trained"), F.sum("n").alias("n"))


# ------------------------------------------------------------------------------------------------------- context tree

def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x of 1/2 or more: Stirling's series after a shift by 8."""
    product = x.copy()
    for k in range(1, 8):
        product *= x + k
    y = x + 8.0
    square = 1 / (y * y)
    series = (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def _log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1.0) - np.log(np.pi)


def _own_share(log_kt: np.ndarray, log_children: np.ndarray) -> np.ndarray:
    """Weight of a node's own estimate against its children in the next prediction."""
    return 1 / (1 + np.exp(np.clip(log_children - log_kt, -700, 700)))


def _nodes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decision node (1 to 255, as in a heap) and outcome of the 8 decisions of each byte, the first in the first column."""
    level = np.arange(8, dtype=_U)
    return (_U(1) << level) | (symbols[:, None] >> (_U(8) - level)), (symbols[:, None] >> (_U(7) - level)) & _U(1)


def subtree(codes: np.ndarray, counts: np.ndarray, top: int = 2):
    """The tree below depth ``top`` for all grams of whole depth-``top`` contexts.

    Returns the probability of each gram's 8 outcomes as seen from depth ``top``, and that depth's nodes: ``(key, n0, n1,
    log weighted probability)``, key being the context followed by the node number.
    """
    nodes, bits = _nodes(codes & _U(0xFF))
    contexts = codes >> _U(8)
    weights = counts.astype(float)
    key = ((contexts[:, None] << _U(8)) | nodes).ravel()
    keys, inverse = np.unique(key, return_inverse=True)
    ones = np.bincount(inverse, (weights[:, None] * bits).ravel(), len(keys))
    n = np.bincount(inverse, np.repeat(weights, 8), len(keys))
    levels = [(keys, n - ones, ones)]
    for depth in range(DEPTH - 1, top - 1, -1):
        below, n0, n1 = levels[-1]
        parent = ((below >> _U(16)) << _U(8)) | (below & _U(0xFF))
        keys, up = np.unique(parent, return_inverse=True)
        levels[-1] = (*levels[-1], up)
        levels.append((keys, np.bincount(up, n0, len(keys)), np.bincount(up, n1, len(keys))))
    logs = [_log_kt(levels[0][1], levels[0][2])]
    shares = []
    for depth in range(1, len(levels)):
        children = np.bincount(levels[depth - 1][3], logs[-1], len(levels[depth][0]))
        own = _log_kt(levels[depth][1], levels[depth][2])
        shares.append(_own_share(own, children))
        logs.append(np.logaddexp(own, children) - np.log(2))
    flat = bits.ravel().astype(bool)
    at = inverse.ravel()
    probability = None
    for depth, level in enumerate(levels):
        hit = np.where(flat, level[2][at], level[1][at])
        estimate = (hit + 0.5) / (level[1][at] + level[2][at] + 1.0)
        if probability is None:
            probability = estimate
        else:
            share = shares[depth - 1][at]
            probability = share * estimate + (1 - share) * probability
        if depth + 1 < len(levels):
            at = level[3][at]
    keys, n0, n1 = levels[-1][:3]
    return probability.reshape(-1, 8), (keys, n0, n1, logs[-1])


def top_tables(keys: np.ndarray, n0: np.ndarray, n1: np.ndarray, log_children: np.ndarray):
    """Own shares and counts of the depth-1 nodes (byte, node) and the depth-0 nodes, given the summed depth-2 ones."""
    counts = np.zeros((2, 256, 256))
    below = np.zeros((256, 256))
    byte, node = (keys >> _U(8)).astype(int), (keys & _U(0xFF)).astype(int)
    counts[0][byte, node], counts[1][byte, node], below[byte, node] = n0, n1, log_children
    own = _log_kt(counts[0], counts[1])
    first = (_own_share(own, below), counts[0], counts[1])
    children = (np.logaddexp(own, below) - np.log(2)).sum(axis=0)
    total = counts.sum(axis=1)
    return first, (_own_share(_log_kt(total[0], total[1]), children), total[0], total[1])


def finish(codes: np.ndarray, probability: np.ndarray, first, root) -> np.ndarray:
    """log10 probability of each gram's next byte, from its outcomes' probabilities as seen from depth 2."""
    nodes, bits = _nodes(codes & _U(0xFF))
    nodes, bits = nodes.astype(int), bits.astype(bool)
    byte = (codes >> _U(8 * DEPTH)).astype(int)[:, None]
    for share, zeros, ones, at in ((*first, (byte, nodes)), (*root, (nodes,))):
        estimate = (np.where(bits, ones[at], zeros[at]) + 0.5) / (zeros[at] + ones[at] + 1.0)
        probability = share[at] * estimate + (1 - share[at]) * probability
    return np.log10(probability).sum(axis=1)


def _subtree_batches(batches):
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    whole = pa.Table.from_batches(held)
    codes = whole["key"].to_numpy().view(np.uint64)
    probability, (keys, n0, n1, logs) = subtree(codes, whole["trained"].to_numpy())
    packed_rows = packed.binary_rows(probability.astype(np.float32).ravel(), np.arange(len(codes) + 1) * 8)
    none, zero = pa.nulls(len(codes), pa.float64()), pa.nulls(len(keys), pa.binary())
    for at in range(0, len(codes), 1 << 16):
        k = len(codes[at:at + (1 << 16)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(packed.signed(codes[at:at + k])), whole["n"].slice(at, k).combine_chunks(), packed_rows.slice(at, k), none[:k], none[:k], none[:k]],
            ["key", "n", "outcomes", "n0", "n1", "logs"],
        )
    yield pa.RecordBatch.from_arrays(
        [pa.array(packed.signed(keys)), pa.nulls(len(keys), pa.int64()), zero, pa.array(n0), pa.array(n1), pa.array(logs)],
        ["key", "n", "outcomes", "n0", "n1", "logs"],
    )


def gram_model(counts: DataFrame) -> DataFrame:
    """``(key, n, value)``: log10 probability of every gram in ``counts`` (key, trained, n)."""
    by_context = counts.select("key", "trained", "n").repartition(F.shiftright("key", 8 * (DEPTH - 1)))
    built = materialize(by_context.mapInArrow(_subtree_batches, "key long, n long, outcomes binary, n0 double, n1 double, logs double"), "tree")
    node = F.shiftright("key", 16) * 256 + F.col("key").bitwiseAND(F.lit(255))
    upper = built.where("outcomes IS NULL").groupBy(node.alias("node")).agg(F.sum("n0"), F.sum("n1"), F.sum("logs")).toArrow()
    columns = [upper.column(k).to_numpy() for k in range(4)]
    first, root = top_tables(columns[0].view(np.uint64), *columns[1:])

    def values(batches):
        for batch in batches:
            codes = batch.column(0).to_numpy().view(np.uint64)
            data, _ = packed.flat(batch.column(2))
            seen = np.frombuffer(data.tobytes(), dtype=np.float32).astype(float).reshape(len(codes), 8)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(finish(codes, seen, first, root))], ["key", "n", "value"])

    return built.where("outcomes IS NOT NULL").select("key", "n", "outcomes").mapInArrow(values, "key long, n long, value double")


# ------------------------------------------------------------------------------------------------------------ look-up

class Lookup:
    """An open-addressing hash table of 64-bit keys as flat arrays, filled and read a whole array at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.slots = np.full(1 << self.bits, -1, dtype=np.int32)
        self.keys, self.values = keys, values
        left, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            lost = self.slots[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key in ``values``, -1 where it is missing."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int32)
        slot = self._slot(keys)
        found = self.slots[slot]
        left = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.slots) - 1)
            found[left] = self.slots[slot[left]]
            left = left[(found[left] >= 0) & (self.keys[found[left]] != keys[left])]
        return found


def _frequent(table: DataFrame, bound: int) -> int:
    """Least count such that at most ``bound`` rows have it or a larger one."""
    by_count = table.groupBy(F.ceil(F.log2("n") * 8).alias("step")).count().orderBy(F.desc("step")).collect()
    total, step = 0, 8 * 64
    for row in by_count:
        total += row["count"]
        if total > bound:
            break
        step = row["step"]
    return step


def _head(table: DataFrame, bound: int) -> tuple[Lookup, DataFrame]:
    """The frequent rows of ``table`` (key, n, value) as a look-up table, and the other rows."""
    step = _frequent(table, bound)
    common = F.ceil(F.log2("n") * 8) >= step
    rows = table.where(common).select("key", "value").toArrow()
    return Lookup(rows["key"].to_numpy().view(np.uint64), rows["value"].to_numpy().astype(float)), table.where(~common).select("key", "value")


_SCORED = ["kind", "uid", "id", "held_out", "n_symbols", "n_tokens", "n_known", "base", "score", "key", "times"]


def _score(tables, key_type):
    def run(batches):
        gram_table, word_table = tables.value
        for batch in batches:
            texts, uid, key, out_of_sample = batch.columns
            for rows, data, offsets in packed.chunks(texts, lower=True):
                n = len(offsets) - 1
                codes, bounds = grams(data, offsets)
                words, at = _row_words(data, offsets)
                sums, missing = [], []
                for kind, table, keys, row in (
                    (GRAM, gram_table, codes, np.repeat(np.arange(n), np.diff(bounds))), (WORD, word_table, words, at)
                ):
                    found = table.find(keys)
                    hit = found >= 0
                    value = np.where(hit, table.values[found], 0.0) if len(table.values) else np.zeros(len(keys))
                    sums.append((value, row, hit))
                    missing.append((kind, keys[~hit], row[~hit]))
                value, row, _ = sums[0]
                score = np.bincount(row, value, n)
                value, row, hit = sums[1]
                counted = hit & (value > 0)
                base = np.bincount(row, np.where(hit, np.log10(value + SMOOTHING), 0.0), n)
                here = uid.slice(rows.start, n)
                size = [pa.array(np.diff(bounds)), pa.array(np.bincount(row, minlength=n)), pa.array(np.bincount(row, counted, n).astype(np.int64))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, -1, np.int32)), here, key.slice(rows.start, n), out_of_sample.slice(rows.start, n), *size, pa.array(base), pa.array(score), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
                    _SCORED,
                )
                ids = here.to_numpy()
                for kind, keys, row in missing:
                    if not len(keys):
                        continue
                    order = np.lexsort((keys, row))
                    keys, row = keys[order], row[order]
                    first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])])
                    k = len(first)
                    empty = pa.nulls(k, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(k, kind, np.int32)), pa.array(ids[row[first]]), pa.nulls(k, key_type), pa.nulls(k, pa.bool_()), empty, empty, empty,
                         pa.nulls(k, pa.float64()), pa.nulls(k, pa.float64()), pa.array(packed.signed(keys[first])), pa.array(np.diff(np.r_[first, len(keys)]).astype(np.int64))],
                        _SCORED,
                    )

    return run


def score(
    docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 10, head_grams: int = 1 << 21, head_words: int = 1 << 20
) -> DataFrame:
    """Score every text by the model learnt from the rows that are not held out.

    ``(key, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte)``: ``score`` is the log10 probability of the
    lower-cased text and its end; ``bits_per_byte`` its code length by its number of bytes and end; ``base_score`` comes from smoothed word counts.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(text).alias("text"), (~held_out(F.col(key), folds)).alias("trained"))
    counts = materialize(corpus_counts(rows), "counts")
    words = counts.where(F.col("kind") == WORD).select("key", "n", F.col("trained").cast("double").alias("value"))
    total, distinct = words.agg(F.sum("value"), F.sum((F.col("value") > 0).cast("long"))).first()
    total, distinct = int(total or 0), int(distinct or 0)
    norm = float(np.log10(total + SMOOTHING * (distinct + 1)))
    model = materialize(gram_model(counts.where(F.col("kind") == GRAM)), "model")
    gram_head, gram_tail = _head(model, head_grams)
    word_head, word_tail = _head(words, head_words)
    tables = spark.sparkContext.broadcast((gram_head, word_head))
    key_type = docs.select(key).schema[0].dataType
    texts = docs.select(F.col(text).alias("text"), F.monotonically_increasing_id().alias("uid"), F.col(key).alias("id"), held_out(F.col(key), folds).alias("held_out"))
    schema = f"kind int, uid long, id {key_type.simpleString()}, held_out boolean, n_symbols long, n_tokens long, n_known long, base double, score double, key long, times long"
    scored = materialize(texts.mapInArrow(_score(tables, to_arrow_type(key_type)), schema), "scored")
    tail = gram_tail.select(F.lit(GRAM).alias("kind"), "key", "value").union(word_tail.select(F.lit(WORD).alias("kind"), "key", "value"))
    missing = scored.where("kind >= 0").select("kind", "uid", "key", "times").join(tail, ["kind", "key"])
    is_word = F.col("kind") == WORD
    rest = missing.groupBy("uid").agg(
        F.sum(F.when(is_word, F.log10(F.col("value") + SMOOTHING) * F.col("times")).otherwise(0.0)).alias("more_base"),
        F.sum(F.when(is_word & (F.col("value") > 0), F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.when(~is_word, F.col("value") * F.col("times")).otherwise(0.0)).alias("more_score"),
    )
    whole = scored.where("kind < 0").join(rest, "uid", "left")

    def plus(name: str, more: str):
        return F.col(name) + F.coalesce(F.col(more), F.lit(0))

    return whole.select(
        F.col("id").alias(key), "held_out", "n_tokens",
        plus("n_known", "more_known").cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (plus("base", "more_base") - F.col("n_tokens") * norm).alias("base_score"),
        plus("score", "more_score").alias("score"),
        (-plus("score", "more_score") / (F.col("n_symbols") * float(np.log10(2)))).alias("bits_per_byte"),
    )
