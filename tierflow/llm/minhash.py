"""MinHash near-dedup with HyperMinHash registers, exact links and connected components.

A document's set is its distinct word shingles. One hash per shingle serves a fixed number of buckets: each bucket keeps its
least hash, compressed to the number of leading zeros and the bits after the first one. Bands of registers are compared;
pairs that share a band are candidates. Their Jaccard index is estimated from the registers, corrected for registers that
agree by chance, and pairs that are clearly too far apart (several standard deviations) go. The rest is verified on the
full shingle sets.

A band is a fixed choice of registers, more of them for smaller sets, so that about ``STRENGTH`` of them are in use: with
fewer, one frequent shingle would throw unrelated short texts together. Sets are banded by the larger of two sizes: a set
joins the classes of all sizes that a partner may have and that are not below its own. With 40 bands and 5 registers in
use a pair at a similarity of 0.8 shares no band with probability 1e-7.

Equal sets are one *node*. Within a band bucket, nodes are first compared with one of them (a star), so a large group of
copies costs as many rows as it has members. Nodes of a bucket that are still in different components are compared in
blocks of bounded size on their full sets; a pair of blocks returns the edges of a spanning forest, never its pairs. The
largest component of a bucket meets only the nodes outside it.

Defined cases: null texts and texts without words have no shingles and link with nothing; with fewer words than a shingle
has, the whole sequence is the one shingle; rows with equal ids are one node's members like others; a null id links, but
names no component; a row without id and named component has component null; an empty table gives an empty one; other
columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..runtime import materialize
from . import packed
from .bitmaps import BITS, bitmap, contains
from .components import connected_components, forest

REGISTERS = 200
BANDS = 40
STRENGTH = 5
MANTISSA = 10
BLOCK = 1024
DEVIATIONS = 5.0

_U = np.uint64


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes sorted by row and hash, and their row offsets."""
    starts, ends, at = packed.word_spans(data, offsets, packed.VISIBLE)
    n = len(offsets) - 1
    hashes, rows = packed.shingles(packed.span_hashes(data, starts, ends), packed.row_starts(at, n), width)
    order = np.argsort((rows.astype(_U) << _U(48)) | (hashes >> _U(16)), kind="stable")
    hashes, rows = hashes[order], rows[order]
    if len(hashes):
        new = np.r_[True, (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])]
        hashes, rows = hashes[new], rows[new]
    return hashes, packed.row_starts(rows, n)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=_U)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def fingerprints(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of each row's set."""
    size = np.diff(bounds).astype(_U)
    return packed.mix(_sums(hashes, bounds) + size), packed.mix(_sums(packed.mix(hashes ^ _U(0x5851F42D4C957F2D)), bounds) + size)


def registers(hashes: np.ndarray, bounds: np.ndarray, count: int = REGISTERS) -> np.ndarray:
    """Registers of each row as a matrix of 16-bit numbers, 0 for an empty bucket."""
    n = len(bounds) - 1
    out = np.zeros((n, count), dtype=np.uint16)
    if not len(hashes):
        return out
    rows = np.repeat(np.arange(n), np.diff(bounds))
    high, low = hashes >> _U(32), hashes & _U(0xFFFFFFFF)
    bucket = ((high * _U(count) + ((low * _U(count)) >> _U(32))) >> _U(32)).astype(np.int64)
    first = np.r_[True, (bucket[1:] != bucket[:-1]) | (rows[1:] != rows[:-1])]
    inside = ((hashes[first] * _U(count)) >> _U(11)).astype(np.float64)  # place in the bucket, 53 bits
    fraction, exponent = np.frexp(inside)
    zeros = np.where(inside > 0, 53 - exponent, 53)
    digits = np.where(inside > 0, np.floor((2 * fraction - 1) * (1 << MANTISSA)), 0)
    out[rows[first], bucket[first]] = (zeros * (1 << MANTISSA) + digits + 1).astype(np.uint16)
    return out


def _registers_per_band(n: np.ndarray, count: int = REGISTERS) -> np.ndarray:
    """How many registers make a band for sets of ``n`` shingles: about ``STRENGTH`` in use, at most half of all; in steps of a quarter power of 2."""
    used = count * -np.expm1(-n / count)
    wanted = np.clip(STRENGTH * count / np.maximum(used, 1e-9), STRENGTH, count / 2)
    return np.rint(2.0 ** (np.round(np.log2(wanted) * 4) / 4)).astype(np.int64)


def _choice(size: int, count: int = REGISTERS) -> np.ndarray:
    """0/1 matrix (registers, bands) of the registers in each band: disjoint runs of shuffles of all registers."""
    random = np.random.Generator(np.random.PCG64(size))
    out = np.zeros((count, BANDS), dtype=_U)
    per_shuffle = count // size
    for band in range(BANDS):
        if band % per_shuffle == 0:
            order = random.permutation(count)
        first = band % per_shuffle * size
        out[order[first:first + size], band] = 1
    return out


def band_keys(matrix: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(keys, rows)`` of all bands of the registers ``matrix``, ``sizes`` registers each, but for bands without any register in use."""
    scrambled = packed.mix(matrix.astype(_U) + (np.arange(1, matrix.shape[1] + 1, dtype=_U) << _U(20)))
    scrambled[matrix == 0] = 0
    keys, rows = [], []
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        choice = _choice(int(size), matrix.shape[1])
        sums = scrambled[at] @ choice
        used = sums != 0
        labels = packed.mix(np.arange(BANDS, dtype=_U) + _U(BANDS * int(size)))
        keys.append(packed.mix(sums + labels)[used])
        rows.append(at[np.nonzero(used)[0]])
    return np.concatenate(keys), np.concatenate(rows)


def chance_agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Probability that registers of different shingles agree, for sets of ``a`` and ``b`` shingles per bucket."""
    total = np.zeros(len(a))
    for zeros in range(54):
        low, high = 2.0 ** -(zeros + 1), 2.0**-zeros
        total += low / (1 << MANTISSA) * (np.exp(-(a + b) * low) - np.exp(-(a + b) * high))
    return np.clip(total * a * b / (a + b), 0.0, 0.5)


def estimate(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates and the number of registers they rest on."""
    used = ((left != 0) | (right != 0)).sum(axis=1)
    same = ((left == right) & (left != 0)).sum(axis=1)
    chance = chance_agreement(n_left / left.shape[1], n_right / left.shape[1])
    return (same / np.maximum(used, 1) - chance) / (1 - chance), used


def _matrix(column: pa.Array) -> np.ndarray:
    data, _ = packed.flat(column)
    return np.frombuffer(data.tobytes(), dtype=np.uint16).reshape(len(column), -1)


def _plausible(threshold: float, deviations: float):
    @F.arrow_udf(T.BooleanType())
    def plausible(left: pa.Array, right: pa.Array, n_left: pa.Array, n_right: pa.Array) -> pa.Array:
        sizes = [n.to_numpy(zero_copy_only=False).astype(float) for n in (n_left, n_right)]
        if not len(left):
            return pa.array([], pa.bool_())
        value, used = estimate(_matrix(left), _matrix(right), *sizes)
        return pa.array(value >= threshold - deviations * np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1)))

    return plausible


def _sketch_rows(width: int):
    def tasks(batches):
        for batch in batches:
            keys = batch.column(1)
            for rows, data, offsets in packed.chunks(batch.column(0), lower=True):
                hashes, bounds = shingle_sets(data, offsets, width)
                size = np.diff(bounds)
                one, two = fingerprints(hashes, bounds)
                matrix = registers(hashes, bounds)
                where = np.arange(len(size) + 1) * REGISTERS
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(rows.start, len(size)), pa.array(size.astype(np.int64)), pa.array(packed.signed(one), mask=size == 0), pa.array(packed.signed(two), mask=size == 0), packed.binary_rows(matrix.ravel(), where)],
                    ["id", "n_shingles", "node", "check", "registers"],
                )

    return tasks


def _band_rows(percent: int):
    def tasks(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                matrix, n = _matrix(part.column(2)), part.column(1).to_numpy().astype(float)
                own, largest = _registers_per_band(n), _registers_per_band(n * 100 / percent)
                between = [_registers_per_band(n * (100 / percent) ** f) for f in (0.25, 0.5, 0.75)]
                done = []
                for sizes in (own, *between, largest):
                    fresh = np.flatnonzero(np.all([sizes != d for d in done], axis=0) if done else np.ones(len(sizes), bool))
                    done.append(sizes)
                    if len(fresh):
                        keys, rows = band_keys(matrix[fresh], sizes[fresh])
                        yield pa.RecordBatch.from_arrays([pa.array(packed.signed(keys)), part.column(0).take(pa.array(fresh[rows]))], ["bucket", "node"])

    return tasks


def _set_rows(width: int, wanted: np.ndarray):
    def tasks(batches):
        for batch in batches:
            batch = batch.filter(pa.array(contains(wanted, batch.column(1).to_numpy())))
            for _, data, offsets in packed.chunks(batch.column(0), lower=True):
                hashes, bounds = shingle_sets(data, offsets, width)
                one, _ = fingerprints(hashes, bounds)
                yield pa.RecordBatch.from_arrays([pa.array(packed.signed(one)), packed.binary_rows(hashes, bounds)], ["node", "shingles"])

    return tasks


def _verified(percent: int):
    def tasks(batches):
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(x.as_buffer(), dtype=_U) for x in (left, right))
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return tasks


def linked(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Matrix of the pairs of sets with a Jaccard index of ``percent`` / 100 or more, from sums over their shared shingles."""
    sides = [np.concatenate(x) if x else np.zeros(0, _U) for x in (left, right)]
    sizes = [np.array([len(s) for s in x]) for x in (left, right)]
    rows = [np.repeat(np.arange(len(n)), n) for n in sizes]
    shared = np.intersect1d(np.unique(sides[0]), np.unique(sides[1]), assume_unique=True)
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    places = []
    for values, row in zip(sides, rows):
        at = np.searchsorted(shared, values)
        inside = np.flatnonzero(at < len(shared))
        inside = inside[shared[at[inside]] == values[inside]]
        order = np.argsort(at[inside], kind="stable")
        places.append((at[inside][order], row[inside][order]))
    for first in range(0, len(shared), 4096):
        held = []
        for (at, row), n in zip(places, sizes):
            low, high = np.searchsorted(at, [first, first + 4096])
            part = np.zeros((len(n), 4096), dtype=np.float32)
            part[row[low:high], at[low:high] - first] = 1
            held.append(part)
        common += held[0] @ held[1].T
    return 100 * common >= percent * (sizes[0][:, None] + sizes[1][None, :] - common)


def _groups(batches, keys: int):
    """Consecutive rows with equal first ``keys`` columns, as tables; the rows come sorted by them."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in range(keys)]
        new = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            key = tuple(c[low] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _block_links(percent: int):
    def tasks(batches):
        found = []
        for group in _groups(batches, 3):
            one, two, block, node, label = (group.column(k).to_numpy() for k in (1, 2, 3, 4, 5))
            sets = [np.frombuffer(x.as_buffer(), dtype=_U) for x in group.column(6)]
            a = np.flatnonzero(block == one[0])
            b = np.flatnonzero(block == two[0])
            if one[0] == two[0]:  # the largest component is compared with the others only
                names, counts = np.unique(label[a], return_counts=True)
                a = a[label[a] != names[counts.argmax()]]
            if not len(a) or not len(b):
                continue
            apart = label[a][:, None] != label[b][None, :]
            if not apart.any():
                continue
            i, j = np.nonzero(linked([sets[k] for k in a], [sets[k] for k in b], percent) & apart)
            if len(i):
                root = forest(a[i], b[j], len(node))
                at = np.flatnonzero(root != np.arange(len(node)))
                found.append((node[at], node[root[at]]))
            if len(found) >= 256:
                yield _edge_batch(found)
                found = []
        if found:
            yield _edge_batch(found)

    return tasks


def _edge_batch(found: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found])) for k in (0, 1)], ["u", "v"])


def _star_links(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(u, v)`` of the pairs that are similar enough: sizes first, then the estimate, then the full sets."""
    names = nodes.select("node", "n", "registers")
    one = names.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.col("registers").alias("ru"))
    two = names.select(F.col("node").alias("v"), F.col("n").alias("nv"), F.col("registers").alias("rv"))
    possible = F.least("nu", "nv") * 100 >= F.greatest("nu", "nv") * percent
    joined = pairs.join(one, "u").join(two, "v").where(possible)
    likely = joined.where(_plausible(percent / 100, DEVIATIONS)("ru", "rv", "nu", "nv")).select("u", "v")
    first = sets.select(F.col("node").alias("u"), F.col("shingles").alias("su"))
    second = sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv"))
    full = likely.join(first, "u").join(second, "v").select("u", "v", "su", "sv")
    return full.mapInArrow(_verified(percent), "u long, v long")


def _rest_work(members: DataFrame, labels: DataFrame, block: int) -> DataFrame:
    """``(bucket, one, two, block, node, label)``: the groups to compare in buckets with several components.

    A bucket of up to two blocks is one group. In larger ones the largest component is in blocks of its own, which meet
    only the blocks of the other nodes, as pairs inside one component need no comparison: a large group with a few strays
    costs one row per member. No group has more than about two blocks of rows.
    """
    labelled = members.select("bucket", "node").join(labels.withColumnRenamed("id", "node"), "node", "left")
    labelled = labelled.withColumn("label", F.coalesce("component", "node")).drop("component")
    parts = labelled.groupBy("bucket", "label").agg(F.count("*").alias("size"))
    mixed = parts.groupBy("bucket").agg(F.max(F.struct("size", "label")).alias("main"), F.sum("size").alias("size"), F.count("*").alias("parts"))
    mixed = mixed.where("parts > 1 and size > 2").select(
        "bucket", "size", F.col("main.label").alias("main"),
        F.ceil((F.col("size") - F.col("main.size")) / block).alias("blocks"), F.ceil(F.col("main.size") / block).alias("main_blocks"),
    )
    rest, names = labelled.join(mixed, "bucket"), ["bucket", "one", "two", "block", "node", "label"]
    zero = F.lit(0).cast("long")
    small = rest.where(F.col("size") <= 2 * block).withColumns({"one": zero, "two": zero, "block": zero})
    large, hashed, central = rest.where(F.col("size") > 2 * block), F.xxhash64("node", "bucket"), F.col("label") == F.col("main")
    large = large.withColumn("block", F.when(central, F.col("blocks") + F.pmod(hashed, "main_blocks")).otherwise(F.pmod(hashed, "blocks")))
    last = F.when(central, F.col("blocks")).otherwise(F.col("blocks") + F.col("main_blocks")) - 1
    large = large.select("bucket", "block", "node", "label", F.explode(F.sequence(zero, last)).alias("other"))
    large = large.withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other")})
    return small.select(*names).union(large.select(*names))


def _rest_links(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """``(u, v)``: links between nodes of one bucket that are in different components so far, as spanning forests of pairs of blocks."""
    work = _rest_work(members, labels, block).join(sets, "node").select("bucket", "one", "two", "block", "node", "label", "shingles")
    work = work.repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two")
    return work.mapInArrow(_block_links(percent), "u long, v long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """``(key, n_shingles, component_id, kept)`` per row: rows linked at a Jaccard index of ``percent`` / 100 or more share a component."""
    kind = docs.select(key).schema[0].dataType
    rows = docs.select(F.col(text).alias("text"), F.col(key).alias("id"))
    sketch = rows.mapInArrow(_sketch_rows(width), f"id {kind.simpleString()}, n_shingles long, node long, check long, registers binary")
    sketch = materialize(sketch, "sketch")
    nodes = sketch.where("n_shingles > 0").groupBy("node").agg(F.max("n_shingles").alias("n"), F.min("id").alias("least"), F.first("registers").alias("registers"))
    nodes = materialize(nodes, "nodes")
    bands = nodes.select("node", "n", "registers").mapInArrow(_band_rows(percent), "bucket long, node long")
    buckets = bands.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("centre")).where("size > 1")
    members = materialize(bands.join(buckets.drop("size"), "bucket"), "members")

    named = members.select("node").distinct().join(nodes.select("node", "least"), "node")
    wanted = bitmap(named, F.xxhash64("least"), bits)
    sets = rows.select("text", F.xxhash64("id").alias("hash")).mapInArrow(_set_rows(width, wanted), "node long, shingles binary")
    sets = materialize(sets.dropDuplicates(["node"]), "sets")

    stars = members.where("node <> centre").select(F.col("node").alias("u"), F.col("centre").alias("v")).distinct()
    edges = materialize(_star_links(stars, nodes, sets, percent), "links")
    labels = connected_components(edges)
    more = _rest_links(members, labels, sets, percent, block)
    labels = connected_components(edges.union(more))

    grouped = nodes.select("node", "least").join(labels.withColumnRenamed("id", "node"), "node", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "node"))
    smallest = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    grouped = grouped.join(smallest, "component").select("node", "component_id")
    out = sketch.select("id", "n_shingles", "node").join(grouped, "node", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"), (F.col("id") == component).alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row of every group of near duplicates, columns as they were: that of the smallest id.

    Verdicts are by id and text, so an id with several texts keeps each that is in a group of its own. Of rows with equal
    id and text one stays; rows without id stay and push no other row out.
    """
    mark = F.xxhash64(docs[text])
    marked = docs.select(F.struct(docs[key].isNull().alias("unnamed"), docs[key].alias("id"), mark.alias("mark")).alias("row"), docs[text].alias("text"))
    found = near_duplicates(marked, "row", "text", width, percent).where("kept AND NOT row.unnamed")
    kept = materialize(found.groupBy("row").agg(F.count("*").alias("__rows")), "kept")
    same = (docs[key] == kept["row"]["id"]) & (mark == kept["row"]["mark"])
    rows = docs.join(kept.where("__rows = 1"), same, "left_semi").unionByName(docs.where(docs[key].isNull()))
    if kept.where("__rows > 1").isEmpty():
        return rows
    repeated = docs.join(kept.where("__rows > 1"), same, "left_semi").withColumn("__mark", F.xxhash64(text))
    return rows.unionByName(repeated.dropDuplicates([key, "__mark"]).drop("__mark"))
