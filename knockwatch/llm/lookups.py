"""Joins of a large table with stored keys of few of its rows, without moving the others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knockwatch.llm.store import cut

#: Stored rows that may be broadcast to find theirs; beyond so many, both sides are shuffled.
BROADCAST_ROWS = 400_000
#: Places in a bitmap for each key, and the most places it may have (32 MB).
BITS_EACH, MOST_BITS = 16, 1 << 28


def found_by(table: DataFrame, stored: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``table`` joined with a ``stored`` one by ``key``. Small ones are sent to every task; for others, rows of ``table``
    are shuffled only where a bitmap of hashes says that their key may be there: a full bitmap lets all pass."""
    rows = stored.count()
    if rows <= BROADCAST_ROWS:
        return table.join(F.broadcast(stored), key, how)
    return likely(table, stored, key, rows).join(stored, key, how)


def likely(table: DataFrame, stored: DataFrame, key: str, rows: int) -> DataFrame:
    """Rows of ``table`` whose ``key`` is in ``stored`` (about so many ``rows``), and some others."""
    bits = 1 << 15
    while bits < min(MOST_BITS, BITS_EACH * rows):
        bits *= 2
    place = F.xxhash64(key).bitwiseAND(F.lit(bits - 1))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    met = stored.select(F.shiftright(place, 6).alias("word"), mask.alias("mask"))
    every = stored.sparkSession.range(bits >> 6).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))
    words = met.unionByName(every).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    blocks = words.groupBy(F.shiftright("word", 9).alias("_block")).agg(F.array_sort(F.collect_list(F.struct("word", "mask"))).alias("all"))
    bitmap = F.broadcast(cut(blocks.select("_block", F.col("all.mask").alias("_masks"))))
    word = F.get("_masks", F.shiftright(place, 6).bitwiseAND(F.lit(511)).cast("int"))
    marked = table.withColumn("_block", F.shiftright(place, 15)).join(bitmap, "_block")
    return marked.filter(F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1).select(*table.columns)
