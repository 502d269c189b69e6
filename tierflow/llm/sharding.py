"""Rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair draws a waiting time from the key's hash: ``-ln(u) / weight``, with ``u`` uniform in (0, 1). A row
belongs to the shard with the least time, so shards are chosen in proportion to their weights, a row depends on nothing
but its key and the shard list, and another shard takes rows only into itself: about its own share of all rows moves.

Defined cases: equal keys share a shard; a null key is a key like any other (all null keys share a shard); an empty
table gives an empty one; a shard of weight 0 gets no rows; a column already named like an output column is replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize


def _times(key: Column, shards: Mapping[int, float]) -> Column:
    listed = F.array(*[F.struct(F.lit(int(s)).alias("shard"), F.lit(float(w)).alias("weight")) for s, w in shards.items() if w > 0])

    def waiting(shard: Column) -> Column:
        uniform = (F.shiftrightunsigned(F.xxhash64(key, shard["shard"]), 11).cast("double") + F.lit(0.5)) * F.lit(2.0**-53)
        return F.struct((-F.ln(uniform) / shard["weight"]).alias("time"), shard["shard"].alias("shard"))

    return F.transform(listed, waiting)


def shard_of(key: Column, shards: Mapping[int, float]) -> Column:
    """The shard number (int) of ``key`` among ``shards``, a mapping of shard number to weight."""
    if not any(weight > 0 for weight in shards.values()) or any(weight < 0 for weight in shards.values()):
        raise ValueError("shards need weights of 0 or more, one of them positive")
    return F.array_min(_times(key, shards))["shard"].cast("int")


def assign_shards(df: DataFrame, key: str, shards: Mapping[int, float], out: str = "shard") -> DataFrame:
    """``df`` with the shard of each row: one pass without any shuffle."""
    return df.withColumn(out, shard_of(F.col(key), shards))


def write_shards(df: DataFrame, key: str, shards: Mapping[int, float], path: str) -> None:
    """Write each shard to a directory of its own, with as many files as it needs."""
    sharded = assign_shards(df, key, shards)
    sharded.hint("rebalance", F.col("shard")).write.partitionBy("shard").parquet(path)


def number_slots(df: DataFrame, shard: str = "shard", out: str = "slot") -> DataFrame:
    """Number the rows of each shard 0, 1, 2, ... without gaps; meant for narrow rows.

    The rows are stored once with their place in the scan. A slot is the count of the shard's rows in earlier
    partitions plus the row's number inside its partition, so no task ever holds a whole shard.
    """
    placed = materialize(df.withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id()}), "slots")
    before = Window.partitionBy(shard).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(shard, "__part").agg(F.count("*").alias("__n"))
    offsets = counts.select(shard, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy(shard, "__part").orderBy("__row"))
    numbered = placed.withColumn("__inside", inside).join(offsets, [shard, "__part"])
    return numbered.withColumn(out, F.col("__before") + F.col("__inside") - 1).drop("__part", "__row", "__inside", "__before")


def shard_table(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 16) -> DataFrame:
    """Shard, slot and the shard with one more, per row, with the text's size and checksum (null text: 0 bytes)."""
    now, grown = {k: 1.0 for k in range(shards)}, {k: 1.0 for k in range(shards + 1)}
    content = F.coalesce(F.col(text), F.lit(""))
    narrow = df.select(
        F.col(key),
        (F.octet_length(content).cast("long") + 1).alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col(key), now).alias("shard"),
        shard_of(F.col(key), grown).alias("grown_shard"),
    )
    return number_slots(narrow)
