r"""Best-fit packing of tokenized documents into sequences of a fixed capacity, by matching large items first.

A document is its token ids and an end id. One longer than the capacity is cut into full pieces after a first piece that
takes the remainder, so at most one piece a document is not a full sequence by itself. Of the others, pieces above a third
of the capacity are *large*: at most two of them share a sequence, and greedy matching gives each, from the longest on,
the longest partner that still fits. The small ones then go, from the longest on, into the smallest gap that takes them.

Equal lengths are interchangeable, so the matching works on the number of pieces of each length (at most ``capacity``
numbers, whatever the size of the table) and decides for whole runs of equal pieces at once: *slots* say which ranks of a
length go to which sequences. Spark counts the lengths, ranks the pieces of each length over range partitions, and looks
every rank up in the slots. Their number depends on the capacity only.

Defined cases: a null text counts as an empty one, which has the end id alone; equal rows are packed one by one; a null id
is an id like any other; an empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize
from .running import running_total

CAPACITY = 1024
RANKS = 1 << 44  # more pieces of one length than any table has
SLICE_ROWS = 64

# How a byte-level tokenizer splits a text, and its settings under which ``tiktoken`` gives equal ids.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def _byte_characters() -> dict[str, int]:
    """The byte that a character of a byte-level token stands for: printable Latin-1 is itself, the rest follows from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Token ids of texts by the tokenizer file at ``path``, without added special tokens.

    With a plain byte-level BPE the ids are computed by ``tiktoken`` from the vocabulary of the file, in a third of the
    time and with equal results; texts that hold a special token, and all texts of other tokenizers, go through
    ``tokenizers``.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        settings = json.loads(self.tokenizer.to_str())
        self.special = [x["content"] for x in settings["added_tokens"]]
        split = settings["pre_tokenizer"] or {}
        plain = settings["model"]["type"] == "BPE" and settings["normalizer"] is None and all(split.get(k) == v for k, v in BYTE_LEVEL.items())
        self.quick = self._quick() if plain else None

    def _quick(self):
        import tiktoken

        of = _byte_characters()
        ranks = {bytes(of[c] for c in token): number for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items() if token not in self.special}
        return tiktoken.Encoding("file", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.quick is None or any(x in text for x in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.asarray(self.quick.encode_to_numpy(text, disallowed_special=()), dtype="<u4")


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """One for a worker process."""
    return Encoder(path)


def _piece_rows(path: str, capacity: int, end_id: int, keep_ids: bool):
    def tasks(batches):
        encoder, end = _encoder(path), np.array([end_id], dtype="<u4")
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(first, SLICE_ROWS)
                row, piece, start, length, crc, ids = ([] for _ in range(6))
                for at, text in enumerate(part.column(0).to_pylist()):
                    found = np.concatenate([encoder.encode(text or ""), end])
                    n = len(found)
                    cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                    row += [at] * (len(cuts) - 1)
                    piece += range(len(cuts) - 1)
                    start += cuts[:-1]
                    length += [b - a for a, b in zip(cuts, cuts[1:])]
                    crc += [zlib.crc32(found[a:b]) for a, b in zip(cuts, cuts[1:])]
                    if keep_ids:
                        ids += [found[a:b].astype(np.int32) for a, b in zip(cuts, cuts[1:])]
                columns = {
                    "id": part.column(1).take(pa.array(row, pa.int64())), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                }
                if keep_ids:
                    columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    return tasks


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 2, key: str = "doc_id", text: str = "text", keep_ids: bool = True) -> DataFrame:
    """``(id, piece, start, length, ids_crc32[, ids])`` of every piece. ``tokenizer`` is the path of a file that all machines have."""
    kind = docs.select(key).schema[0].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select(F.col(text).alias("text"), F.col(key).alias("id")).mapInArrow(_piece_rows(tokenizer, capacity, end_id, keep_ids), schema)


class _Bins:
    """Sequences in runs of equal content: ``runs[gap]`` lists (first sequence, how many)."""

    def __init__(self, counts: Mapping[int, int], capacity: int):
        self.capacity, self.left = capacity, dict(counts)
        self.ranks, self.sequences = dict.fromkeys(counts, 0), 0
        self.runs: dict[int, list[tuple[int, int]]] = {}
        self.slots: list[tuple[int, int, int, int, int, int]] = []

    def put(self, length: int, first: int, bins: int, each: int, offset: int) -> None:
        """The next ``bins * each`` pieces of a length go to ``bins`` sequences, ``each`` to one, from ``offset`` on."""
        self.slots.append((length, self.ranks[length], bins * each, first, each, offset))
        self.ranks[length] += bins * each
        self.left[length] -= bins * each

    def open(self, bins: int) -> int:
        self.sequences += bins
        return self.sequences - bins

    def keep(self, gap: int, first: int, bins: int) -> None:
        if bins and gap:
            self.runs.setdefault(gap, []).append((first, bins))

    def fill(self, length: int, first: int, bins: int, gap: int) -> int:
        """Pieces of one length into a run of sequences, as many as fit or are left; the number of sequences not touched."""
        each = gap // length
        full = min(bins, self.left[length] // each)
        if full:
            self.put(length, first, full, each, self.capacity - gap)
            self.keep(gap - each * length, first, full)
        rest = min(self.left[length], each - 1) if full < bins else 0
        if rest:
            self.put(length, first + full, 1, rest, self.capacity - gap)
            self.keep(gap - rest * length, first + full, 1)
        return bins - full - bool(rest)


def _match_large(bins: _Bins, large: list[int]) -> None:
    """``large`` is sorted from the longest on. Each takes the longest partner that fits, or opens a sequence alone."""
    for length in large:
        for partner in large:
            if not bins.left[length]:
                break
            if partner > length or length + partner > bins.capacity or not bins.left[partner]:
                continue
            pairs = bins.left[length] // 2 if partner == length else min(bins.left[length], bins.left[partner])
            if not pairs:
                continue
            first = bins.open(pairs)
            if partner == length:
                bins.put(length, first, pairs, 2, 0)
            else:
                bins.put(length, first, pairs, 1, 0)
                bins.put(partner, first, pairs, 1, length)
            bins.keep(bins.capacity - length - partner, first, pairs)
        if alone := bins.left[length]:
            first = bins.open(alone)
            bins.put(length, first, alone, 1, 0)
            bins.keep(bins.capacity - length, first, alone)


def _fit_small(bins: _Bins, length: int) -> None:
    """All pieces of one length into the smallest gaps that take them, then into new sequences."""
    for gap in sorted(g for g in bins.runs if g >= length):
        runs = bins.runs.pop(gap)
        while runs and bins.left[length]:
            first, size = runs.pop()
            untouched = bins.fill(length, first, size, gap)
            if untouched:
                runs.append((first + size - untouched, untouched))
        if runs:
            bins.runs.setdefault(gap, []).extend(runs)
        if not bins.left[length]:
            return
    new = -(-bins.left[length] // (bins.capacity // length))
    if new:
        bins.fill(length, bins.open(new), new, bins.capacity)


def slots(counts: Mapping[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, ranks, first sequence, pieces a sequence, first offset), sorted, for pieces shorter than the capacity.

    Rank ``r`` of a length lies in the slot with the largest first rank up to ``r``: with ``k = r - first rank`` it goes to
    sequence ``first sequence + k // pieces a sequence``.
    """
    bins = _Bins({length: n for length, n in counts.items() if n and length < capacity}, capacity)
    lengths = sorted(bins.left, reverse=True)
    _match_large(bins, [x for x in lengths if 3 * x > capacity])
    for length in lengths:
        if 3 * length <= capacity:
            _fit_small(bins, length)
    return np.array(sorted(bins.slots), dtype=np.int64).reshape(-1, 6)


def _placed_rows(table: np.ndarray):
    starts = table[:, 0] * RANKS + table[:, 1]

    def tasks(batches):
        for batch in batches:
            length, rank = (batch.column(batch.schema.names.index(c)).to_numpy() for c in ("length", "__rank"))
            slot = table[np.searchsorted(starts, length * RANKS + rank, side="right") - 1]
            k = rank - slot[:, 1]
            placed = {"sequence_id": slot[:, 3] + k // slot[:, 4], "offset": slot[:, 5] + k % slot[:, 4] * length}
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names) if name != "__rank"}
            yield pa.RecordBatch.from_pydict(columns | {name: pa.array(values) for name, values in placed.items()})

    return tasks


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``pieces`` with ``sequence_id`` and ``offset``. Full pieces have negative sequence ids of their own."""
    cut = materialize(cut.withColumn("__uid", F.monotonically_increasing_id()), "pieces")
    names = [c for c in cut.columns if c not in ("__uid", "ids")]
    whole = cut.where(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.col("__uid"), "offset": F.lit(0).cast("long")}).drop("__uid")
    short = cut.where(F.col("length") < capacity)
    table = slots({r["length"]: r["count"] for r in short.groupBy("length").count().collect()}, capacity)
    ranked = running_total(short.select(*names, "__uid", F.lit(1).alias("__one")), "length", ["__uid"], "__one", "__to").withColumn("__rank", F.col("__to") - 1)
    kinds = {f.name: f.dataType.simpleString() for f in cut.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in [*names, "__uid"]) + ", sequence_id long, offset long"
    placed = ranked.select(*names, "__uid", "__rank").mapInArrow(_placed_rows(table), schema)
    if "ids" in cut.columns:
        placed = placed.join(short.select("__uid", "ids"), "__uid")
    return placed.drop("__uid").unionByName(whole)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, length, ids)``: the token ids of every sequence, from packed pieces with ``ids``. A group is one sequence."""
    held = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("held"))
    held = held.select("sequence_id", F.flatten(F.col("held.ids")).alias("ids"))
    return held.select("sequence_id", F.size("ids").cast("long").alias("length"), "ids")
