"""Near-duplicate embeddings: exact cosine links by PCA-ordered tiled comparison.

Unit vectors are turned into the basis of their principal axes. Tiles are runs of vectors sorted along the first axis;
two tiles are compared only if their ranges and their balls on the leading axes come close enough. Inside a pair of
tiles the products of the leading dimensions are accumulated first; the rest of a product is at most the product of the
two suffix norms, so most pairs stop after the first block of dimensions. What is left is decided by the cosine of the
original vectors in double precision.

Equal vectors are one *class* and are compared once. A pair of tiles returns one row per vector with links: how many
vectors it links with, and one edge of a spanning forest; linked pairs are never listed.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite component link with nothing and are
components of their own; vectors of different length never link; equal vectors link with each other; repeated ids count
as rows of their own and share a component; null ids link, but name no component; an empty table gives an empty one;
other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize
from . import packed
from .components import connected_components, forest

TILE_ROWS = 4096
BLOCK = 16
AXES = 4
_SLACK = 1e-9


def usable(vector: str) -> Column:
    """Whether a vector can link at all."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _units(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by the largest component first, so that nothing overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame, vector: str, dims: int) -> np.ndarray:
    """Axes (columns) of the second moments of the unit vectors, largest first; ``dims * dims`` sums reach the driver."""

    def partial(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            if batch.num_rows:
                u = _units(_matrix(batch.column(0), dims))
                total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()])], ["sums"])

    sums = vectors.select(vector).mapInArrow(partial, "sums array<double>").select(F.posexplode("sums").alias("at", "value"))
    rows = sums.groupBy("at").agg(F.sum("value").alias("value")).toPandas()
    moments = np.zeros(dims * dims)
    moments[rows["at"].to_numpy()] = rows["value"].to_numpy()
    return np.linalg.eigh(moments.reshape(dims, dims))[1][:, ::-1].copy()


def _tiler(axes: np.ndarray, tile_rows: int, kind: type):
    """Tasks cut their sorted vectors into tiles: ids, weights and vectors as bytes, range on the first axis, ball on the leading ones."""
    dims = len(axes)

    def tile(number: int, ids: np.ndarray, copies: np.ndarray, x: np.ndarray):
        lead = (_units(x) @ axes)[:, :AXES]
        centre = lead.mean(axis=0)
        radius = float(np.sqrt(((lead - centre) ** 2).sum(axis=1)).max())
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([ids.tobytes()]), pa.array([copies.tobytes()]), pa.array([x.astype(kind).tobytes()]), pa.array([float(lead[:, 0].min())]),
             pa.array([float(lead[:, 0].max())]), pa.array([centre.tolist()], pa.list_(pa.float64())), pa.array([radius])],
            ["tile", "ids", "copies", "vectors", "low", "high", "centre", "radius"],
        )

    def run(batches):
        held, size, number = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if number is None:
                number = batch.column(3)[0].as_py() << 20
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), dims)))
            size += batch.num_rows
            while size >= tile_rows:
                ids, copies, x = (np.concatenate(parts) for parts in zip(*held))
                yield tile(number, ids[:tile_rows], copies[:tile_rows], x[:tile_rows])
                held, size, number = [(ids[tile_rows:], copies[tile_rows:], x[tile_rows:])], size - tile_rows, number + 1
        if size:
            ids, copies, x = (np.concatenate(parts) for parts in zip(*held))
            yield tile(number, ids, copies, x)

    return run


def close_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs of rows of ``a`` and ``b`` with cosine ``threshold`` or more."""
    ua, ub = _units(a), _units(b)
    ra, rb = ua @ axes, ub @ axes

    def suffix(r: np.ndarray, k: int) -> np.ndarray:
        return np.sqrt((r[:, k:] ** 2).sum(axis=1))

    dims = len(axes)
    k = min(BLOCK, dims)
    found_i, found_j = [], []
    sb = suffix(rb, k)
    for at in range(0, len(a), 512):
        rows = slice(at, at + 512)
        partial = ra[rows, :k] @ rb[:, :k].T
        bound = partial + np.multiply.outer(suffix(ra[rows], k), sb)
        i, j = np.nonzero(bound >= threshold - _SLACK)
        product, i = partial[i, j], i + at
        for first in range(k, dims, BLOCK):
            last = min(first + BLOCK, dims)
            product = product + np.einsum("nd,nd->n", ra[i, first:last], rb[j, first:last])
            alive = product + suffix(ra, last)[i] * suffix(rb, last)[j] >= threshold - _SLACK
            i, j, product = i[alive], j[alive], product[alive]
        sure = product >= threshold + _SLACK
        near = np.flatnonzero(~sure)
        if len(near):
            x, y = a[i[near]], b[j[near]]
            x, y = x / np.abs(x).max(axis=1, keepdims=True), y / np.abs(y).max(axis=1, keepdims=True)
            cosine = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
            sure[near] = cosine >= threshold
        found_i.append(i[sure])
        found_j.append(j[sure])
    return np.concatenate(found_i), np.concatenate(found_j)


def _comparer(axes: np.ndarray, threshold: float, kind: type):
    dims = len(axes)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                same = row["tile"] == row["tile2"]
                ids, copies, x = (np.frombuffer(row[c], t) for c, t in (("ids", np.int64), ("copies", np.int64), ("vectors", kind)))
                ids2, copies2, y = (np.frombuffer(row[c + "2"], t) for c, t in (("ids", np.int64), ("copies", np.int64), ("vectors", kind)))
                x, y = (v.reshape(-1, dims).astype(np.float64) for v in (x, y))
                i, j = close_pairs(x, y, axes, threshold)
                if same:
                    i, j = i[i != j], j[i != j]
                if not len(i):
                    continue
                shift = 0 if same else len(ids)
                names = ids if same else np.concatenate([ids, ids2])
                links = np.bincount(i, copies2[j], len(names))
                if not same:
                    links += np.bincount(j + shift, copies[i], len(names))
                root = forest(i, j + shift, len(names))
                linked = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[linked]), pa.array(links[linked].astype(np.int64)), pa.array(names[root[linked]])], ["cid", "links", "root"]
                )

    return run


def _links_of(classes: DataFrame, dims: int, threshold: float, tile_rows: int) -> DataFrame:
    """``(cid, links, root)`` of all classes of one vector length with links to other classes."""
    axes = principal_axes(classes, "vector", dims)
    kind = np.float32 if classes.schema["vector"].dataType.elementType.simpleString() == "float" else np.float64
    first = F.array(*[F.lit(float(x)) for x in axes[:, 0]])
    vector = F.col("vector").cast("array<double>")
    along = F.aggregate(F.zip_with(vector, first, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    scale = F.array_max(F.transform(vector, lambda x: F.abs(x)))
    length = scale * F.sqrt(F.aggregate(F.transform(vector, lambda x: (x / scale) * (x / scale)), F.lit(0.0), lambda s, x: s + x))
    ordered = classes.withColumn("along", along / length).repartitionByRange("along", "cid").sortWithinPartitions("along", "cid")
    part = F.spark_partition_id().cast("long").alias("part")
    tiles = ordered.select("cid", "copies", "vector", part).mapInArrow(
        _tiler(axes, tile_rows, kind), "tile long, ids binary, copies binary, vectors binary, low double, high double, centre array<double>, radius double"
    )
    tiles = materialize(tiles, "tiles")
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    small = tiles.select("tile", "low", "high", "centre", "radius")
    cells = F.sequence(F.floor(F.col("low") / reach), F.floor(F.col("high") / reach))
    wide = F.sequence(F.floor((F.col("low") - reach) / reach), F.floor((F.col("high") + reach) / reach))
    left = small.withColumn("cell", F.explode(cells))
    right = small.select(*[F.col(c).alias(c + "2") for c in small.columns], F.explode(wide).alias("cell"))
    gap = F.aggregate(F.zip_with("centre", "centre2", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    near = (F.col("low2") - F.col("high") <= reach) & (F.col("low") - F.col("high2") <= reach)
    near = near & (F.sqrt(gap) <= F.col("radius") + F.col("radius2") + reach)
    pairs = left.join(right, "cell").where((F.col("tile") <= F.col("tile2")) & near).select("tile", "tile2").distinct()
    body = tiles.select("tile", "ids", "copies", "vectors")
    body2 = body.select(*[F.col(c).alias(c + "2") for c in body.columns])
    work = pairs.join(body, "tile").join(body2, "tile2")
    return work.mapInArrow(_comparer(axes, threshold, kind), "cid long, links long, root long")


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``(key, n_links, component_id, kept)`` of every row."""
    rows = df.select(F.col(key).alias("key"), F.when(usable(vector), F.col(vector)).alias("vector"))
    known = rows.where("vector IS NOT NULL")
    classes = known.groupBy("vector").agg(F.min("key").alias("least"), F.count("*").alias("copies"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    lengths = [r[0] for r in classes.select(F.size("vector")).distinct().collect()]
    links = None
    for dims in sorted(lengths):
        part = _links_of(classes.where(F.size("vector") == dims), dims, threshold, tile_rows)
        links = part if links is None else links.union(part)
    if links is None:
        links = classes.select("cid", F.lit(0).cast("long").alias("links"), F.col("cid").alias("root")).limit(0)
    links = materialize(links, "links")
    component = connected_components(links, "cid", "root").withColumnRenamed("id", "cid")
    totals = links.groupBy("cid").agg(F.sum("links").alias("links"))
    named = classes.join(totals, "cid", "left").join(component, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(smallest, "component").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    out = rows.join(named, "vector", "left")
    component_id = F.coalesce("component_id", "key")
    return out.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component_id.alias("component_id"),
        (F.col("key") == component_id).alias("kept"),
    )
