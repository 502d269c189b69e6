r"""Prefix trie of conversations by truncation peeling.

A node is a sequence of first turns that some conversation starts with. The trie is built from below: at the greatest
depth the conversations that end there are the first nodes; every node loses its last turn, and the nodes that are then
equal are regrouped together with the conversations that end one turn earlier. The regrouping discovers the nodes of a
depth and sums up what lies below them in the same step, so nothing is visited twice.

Turns are narrow from the start: two 64-bit hashes and the number of words. The key of a prefix folds the hashes of its
turns, each mixed with its place, so it is a running fold over range partitions and a conversation may hold any share of
the rows. Keys lie in *bands* of depths, a row per conversation and band with at most ``WIDTH`` + 1 of them, which a row
peels off without a join. Below the first band most nodes have no other in reach: parts whose prefix at the lower end of
a band is nobody else's lose all turns of the band at once; only the others go turn by turn. So a few very long
conversations cost a step per band, not per turn.

Defined cases: a null role or text counts as an empty one; turns are ordered by turn (null first), then by a hash of role
and text, so repeated rows stay as repeated turns; rows without a conversation id belong to no conversation; a
conversation without turns is a member of the root only; an empty table gives an empty trie; other columns are not
looked at.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize, stage
from .mixing import word_count
from .running import running_folds

STEPS, WIDTH = 8, 256  # depths that are peeled one by one; most depths of a band
ENDS = 4096  # conversation ids that share a chunk of text
_SALT = 0x5851F42D
KEY = ["a", "b"]


def numbered_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, place, one, two, words)`` per turn: its place from 1, two hashes of role and text, and the words of the text."""
    said = [F.coalesce(F.col(c), F.lit("")) for c in (role, text)]
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.xxhash64(*said).alias("one"), F.xxhash64(F.lit(_SALT), *said).alias("two"),
        word_count(F.col(text)).alias("words"), F.lit(1).cast("long").alias("count"),
    )
    return running_folds(rows, "conv_id", ["turn", "one", "two"], {"place": ("sum", "count")}).select("conv_id", "place", "one", "two", "words")


def share_heads(placed: DataFrame, block: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations of a block of ids with the first turns of the block's first one: ``(turns, lengths)``.

    Conversation c takes the first h turns of conversation ``c - c % block`` and its own turns after its first h, with
    h = crc32 of its decimal id modulo ``most``. ``turns`` are ``(conv_id, depth, one, two, words, length)``, ``lengths``
    ``(conv_id, length)``, turnless conversations included.
    """
    turn = ["one", "two", "words"]
    own = placed.groupBy("conv_id").agg(F.count("*").alias("own"))
    own = own.withColumns({"h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % most, "first": F.col("conv_id") - F.col("conv_id") % block})
    heads = placed.where((F.col("conv_id") % block == 0) & (F.col("place") < most))
    heads = heads.groupBy(F.col("conv_id").alias("first")).agg(F.sort_array(F.collect_list(F.struct("place", *turn))).alias("head"))
    whole = own.join(heads, "first", "left")
    whole = whole.withColumn("head", F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")), F.array().cast(heads.schema["head"].dataType)))
    whole = whole.withColumn("taken", F.size("head").cast("long"))
    whole = whole.withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0).cast("long")))
    whole = materialize(whole.select("conv_id", "h", "taken", "length", "head"), "conversations")
    taken = whole.select("conv_id", "length", F.explode("head").alias("t"))
    taken = taken.select("conv_id", F.col("t.place").alias("depth"), *[F.col(f"t.{c}").alias(c) for c in turn], "length")
    kept = placed.join(whole.drop("head"), "conv_id").where("place > h")
    kept = kept.select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), *turn, "length")
    return taken.union(kept), whole.select("conv_id", "length")


def _bounds(deepest: int) -> list[int]:
    bounds = [0, STEPS]
    while bounds[-1] < deepest:
        bounds.append(bounds[-1] + min(bounds[-1], WIDTH))
    return bounds


def _band(depth: Column) -> Column:
    """The number of the band with this depth (from 1)."""
    band, bounds = F.when(depth <= STEPS, 0), _bounds(2 * WIDTH)
    for number, bound in enumerate(bounds[2:], 1):
        band = band.when(depth <= bound, number)
    return band.otherwise(F.call_function("div", depth - (bounds[-1] + 1), F.lit(WIDTH)) + len(bounds) - 1).cast("int")


def _at(path: str, depth: Column | int, low: int) -> Column:
    return F.get(path, (depth - low if isinstance(depth, int) else (depth - low).cast("int")))


def _regroup(parts: DataFrame, depth: int, low: int) -> DataFrame:
    """The nodes of a depth from their parts: conversations that end there, and nodes that have just lost a turn."""
    at = parts.withColumn("at", _at("path", depth, low))
    nodes = at.groupBy(F.col("at.a").alias("a"), F.col("at.b").alias("b")).agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("at.words").alias("words"), F.first("path").alias("path"),
    )
    leaves = F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves"))
    nodes = nodes.withColumns({"n_leaves": leaves, "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")})
    above = _at("path", depth - 1, low) if depth else None
    parent = [(above[k] if depth else F.lit(None).cast("long")).alias(f"parent_{k}") for k in KEY]
    return nodes.select(F.lit(depth).cast("long").alias("depth"), *KEY, *parent, "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "path")


def _truncated(nodes: DataFrame) -> DataFrame:
    """Parts of the depth above, one for each node."""
    return nodes.select("conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens", "path")


def _peel_at_once(parts: DataFrame, low: int) -> DataFrame:
    """All nodes of the band above ``low`` for parts that share no prefix in it."""
    last = _at("path", F.col("depth"), low)
    rows = parts.withColumns({"total": last["total"], "end": F.col("depth")}).withColumn("depth", F.explode(F.sequence(F.lit(low + 1).cast("long"), "end")))
    here, above = _at("path", F.col("depth"), low), _at("path", F.col("depth") - 1, low)
    single = F.lit(1).cast("long")
    return rows.select(
        "depth", *[here[k].alias(k) for k in KEY], *[above[k].alias(f"parent_{k}") for k in KEY], "conv_id", "n_convs",
        F.when(F.col("depth") == F.col("end"), F.col("n_children")).otherwise(single).alias("n_children"),
        F.when(F.col("n_children") == 0, single).otherwise(F.col("n_leaves")).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * (F.col("total") - above["total"])).alias("saved_tokens"), "path",
    )


def _keyed(turns: DataFrame) -> DataFrame:
    """The turns with the key of the prefix that they end (two running folds) and the words up to them."""
    placed = ["depth", "one", "two"]
    rows = turns.withColumns({"hash_a": F.xxhash64(*placed), "hash_b": F.xxhash64(F.lit(_SALT), *placed)}).drop("one", "two")
    folds = {"a": ("bit_xor", "hash_a"), "b": ("bit_xor", "hash_b"), "total": ("sum", "words")}
    return materialize(running_folds(rows, "conv_id", ["depth"], folds).drop("hash_a", "hash_b"), "prefixes")


def _paths(keyed: DataFrame, lengths: DataFrame) -> DataFrame:
    """``(conv_id, band, path)``: the prefixes of a band, in order, from that of its lower bound on."""
    zero = F.lit(0).cast("long")
    names = ["depth", *KEY, "words", "total"]
    roots = lengths.select("conv_id", F.lit(0).alias("band"), F.struct(*[zero.alias(c) for c in names]).alias("prefix"))
    bands = F.array_distinct(F.array(_band(F.col("depth")), _band(F.least(F.col("depth") + 1, F.col("length")))))
    rows = keyed.select("conv_id", F.explode(bands).alias("band"), F.struct(*names).alias("prefix"))
    rows = roots.union(rows).groupBy("conv_id", "band").agg(F.sort_array(F.collect_list("prefix")).alias("path"))
    return materialize(rows, "paths")


def _end_digests(batches):
    """One digest per node, streamed over its chunks; the rows come sorted by node and chunk."""
    held, sha, done = None, None, []
    for batch in batches:
        for *node, ids in zip(*[batch.column(k).to_pylist() for k in range(4)]):
            if node == held:
                sha.update(b"," + ids.encode())
                continue
            if held is not None:
                done.append((*held, sha.hexdigest()))
            held, sha = node, hashlib.sha256(ids.encode())
        if done:
            yield _digest_batch(done)
            done = []
    if held is not None:
        yield _digest_batch([(*held, sha.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(dict(zip(("depth", "a", "b", "ends_sha256"), zip(*rows))))


def end_digests(ends: DataFrame) -> DataFrame:
    """``(depth, a, b, ends_sha256)`` of the conversations that end at each node, their ids ascending and comma-joined.

    Ids are first joined in chunks of neighbouring ids, at most ``ENDS`` of them; the chunks of a node stream through its
    digest, as SHA-256 has to see them in order.
    """
    node = ["depth", *KEY]
    chunks = ends.groupBy(*node, F.floor(F.col("conv_id") / ENDS).alias("chunk")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    chunks = chunks.select(*node, "chunk", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    chunks = chunks.repartition(*node).sortWithinPartitions(*node, "chunk").select(*node, "ids")
    return chunks.mapInArrow(_end_digests, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """The nodes: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``.

    ``turns`` is ``(conv_id, depth, one, two, words, length)`` with depths from 1, gapless, and ``lengths`` names every
    conversation. A node is named by its smallest member; ``saved_tokens`` are the words that its subtree would repeat.
    """
    keyed = _keyed(turns)
    paths = _paths(keyed, lengths)
    zero = F.lit(0).cast("long")
    ends = keyed.where(F.col("depth") == F.col("length")).select("conv_id", "depth", *KEY)
    ends = ends.union(lengths.where(F.col("length") == 0).select("conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b")))
    ends = materialize(ends, "ends")
    ended = ends.groupBy("depth", *KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    ended = ended.select("depth", "conv_id", "n_convs", *[zero.alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])
    ended = materialize(ended, "ended")

    bounds = _bounds(ended.agg(F.max("depth")).first()[0] or 0)
    stored: list[str] = []

    def store(nodes: DataFrame) -> DataFrame:
        kept, path = stage(nodes, "nodes")
        stored.append(path)
        return kept

    survivors = ended.limit(0).drop("depth")
    for band in reversed(range(len(bounds) - 1)):
        low, top = bounds[band], bounds[band + 1]
        parts = survivors.withColumn("depth", F.lit(top).cast("long")).unionByName(ended.where(F.col("depth").between(low + 1, top)))
        parts = parts.join(paths.where(F.col("band") == band).drop("band"), "conv_id")
        if band:
            parts = parts.withColumns({f"low_{k}": _at("path", low, low)[k] for k in KEY})
            parts = materialize(parts, "parts")
            alone = parts.groupBy("low_a", "low_b").agg((F.count("*") == 1).alias("alone"))
            parts = materialize(parts.join(alone, ["low_a", "low_b"]).drop("low_a", "low_b"), "parts")
            at_once = store(_peel_at_once(parts.where("alone").drop("alone"), low))
            up = _truncated(at_once.where(F.col("depth") == low + 1))
            parts = parts.where("NOT alone").drop("alone")
            stepwise = not parts.isEmpty()
        else:
            parts, stepwise = materialize(parts, "parts"), True
        if stepwise:
            nodes = None
            for depth in range(top, low, -1):
                here = parts.where(F.col("depth") == depth).drop("depth")
                nodes = store(_regroup(here if nodes is None else here.unionByName(_truncated(nodes)), depth, low))
            up = up.unionByName(_truncated(nodes)) if band else _truncated(nodes)
        survivors = up.drop("path")
    roots = paths.where("band = 0").drop("band")
    store(_regroup(survivors.unionByName(ended.where("depth = 0").drop("depth")).join(roots, "conv_id"), 0, 0))

    nodes = ended.sparkSession.read.schema(nodes.schema).parquet(*stored).drop("path")
    above = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(k).alias(f"parent_{k}") for k in KEY], F.col("conv_id").alias("parent_conv_id"))
    whole = nodes.join(above, ["depth", "parent_a", "parent_b"], "left").join(end_digests(ends), ["depth", *KEY], "left")
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nobody).alias("ends_sha256")
    )
