"""Near-duplicates by SimHash fingerprints and multi-index hashing.

A pair of fingerprints with at most ``max_distance`` differing bits agrees, up to a small
Hamming ball, on at least one of a few bit segments. Each fingerprint is stored in one
table per segment and asks each table for the keys of the ball around its own segment;
what it finds is verified on the complete 64 bits. Equal fingerprints are one entry, so
groups of copies cost nothing.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knockwatch.llm.components import components
from knockwatch.llm.store import cut

BITS = 64
SEED = 42
#: Buckets with more fingerprints than this are linked through midpoints instead of pairs.
HOT_BUCKET = 500
#: Above so many fingerprints two wide segments cost less than three narrow ones.
WIDE_FROM = 20_000_000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_CHUNK = 1 << 16


def _hash_text(text: str | None, width: int) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    width = min(width, len(words))
    starts = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words])))
    begin = starts[: len(words) - width + 1].tolist()
    end = (starts[width:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(begin), _CHUNK):
        spans = zip(begin[at : at + _CHUNK], end[at : at + _CHUNK])
        hashes = np.array([digest(line[i:j], SEED) for i, j in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(begin), bitorder="little").view("<i8")[0])


def fingerprint(text: Column, width: int = 4) -> Column:
    """64-bit fingerprint of the word shingles of ``text`` as a (signed) long.

    A-Z are lower-cased; words are runs without ASCII white space; fewer than ``width``
    words are one shingle; without words (also null) the fingerprint is zero.
    """

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([_hash_text(t, width) for t in texts], dtype="int64")

    return of(text)


def fingerprint_hex(print_: Column) -> Column:
    return F.lower(F.lpad(F.hex(print_), 16, "0"))


def _segments(count: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    edges = [BITS * i // count for i in range(count + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _ball(low: int, width: int, radius: int) -> list[int]:
    """All masks with at most ``radius`` bits set among ``width`` bits from ``low``."""
    bits = range(low, low + width)
    return [sum(1 << b for b in some) for n in range(radius + 1) for some in combinations(bits, n)]


def _long_array(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{_signed(v)}L' if _signed(v) > -(1 << 63) else 'shiftleft(1L, 63)' for v in values)})")


def links(prints: DataFrame, max_distance: int = 4, segments: int | None = None) -> DataFrame:
    """Distinct ``print`` values → links ``a, b`` whose closure joins every pair within
    ``max_distance`` (even) bits; every link joins such a pair.

    With r = q·m + s for m segments, a close pair agrees within q bits on one of the first
    s + 1 segments or within q - 1 bits on one of the rest. Of two fingerprints that differ
    inside a segment only the one with the highest differing bit set asks for the other.
    Pairs are not listed inside crowded buckets (more than ``HOT_BUCKET`` entries): their
    fingerprints, and all that ask for them, name every value within half the distance of
    themselves, and those that name the same value, which are within the distance of each
    other, link to the smallest. That is exact and linear in the size of the bucket.
    """
    if max_distance % 2:
        raise ValueError("max_distance must be even")
    if segments is None:
        segments = 3 if prints.count() <= WIDE_FROM else 2
    radius, extra = divmod(max_distance, segments)
    probes, keys = [], []
    for table, (low, width) in enumerate(_segments(segments)):
        mask = ((1 << width) - 1) << low
        keys.append(F.struct(F.lit(table).alias("t"), F.col("print").bitwiseAND(F.lit(_signed(mask))).alias("key")))
        reach = radius if table <= extra else radius - 1
        if reach < 0:
            continue
        flips = _long_array(_ball(low, width, reach))
        own = F.col("print").bitwiseAND(F.lit(_signed(mask)))
        probes.append(_asked(flips, own, F.lit(table)))
    index = prints.select("print", F.inline(F.array(*keys)))
    asked = prints.select("print", F.inline(F.concat(*probes)))
    crowded = cut(index.groupBy("t", "key").count().filter(F.col("count") > HOT_BUCKET).select("t", "key"))
    near = F.bit_count(F.col("print").bitwiseXOR(F.col("other"))) <= max_distance
    once = F.col("flipped") | (F.col("print") > F.col("other"))
    quiet = index.join(crowded, ["t", "key"], "left_anti").withColumnRenamed("print", "other")
    right = quiet.select("other", F.col("t").alias("t2"), F.col("key").alias("key2"))
    on = (F.col("t") == F.col("t2")) & (F.col("key") == F.col("key2")) & near & once
    pairs = asked.join(right, on).select(F.col("print").alias("a"), F.col("other").alias("b"))
    dense = asked.join(crowded, ["t", "key"], "left_semi").select("print").distinct()
    middles = dense.select("print", F.explode(_long_array(_ball(0, BITS, max_distance // 2))).alias("flip"))
    named = middles.groupBy(F.col("print").bitwiseXOR(F.col("flip")).alias("middle")).agg(
        F.collect_set("print").alias("all")  # no more than a ball holds
    )
    star = named.filter(F.size("all") > 1).select(F.array_min("all").alias("a"), F.explode("all").alias("b"))
    return pairs.unionByName(star.filter("a <> b")).distinct()


def _asked(flips: Column, own: Column, table: Column) -> Column:
    """The keys one fingerprint asks one table for: its own, and each flip whose highest bit is set in it."""

    def top_is_set(flip: Column) -> Column:
        # own ^ flip < own (unsigned) exactly when the highest flipped bit is set
        sign = F.expr("shiftleft(1L, 63)")
        return (flip == 0) | (own.bitwiseXOR(flip).bitwiseXOR(sign) < own.bitwiseXOR(sign))

    def key(flip: Column) -> Column:
        return F.struct(table.alias("t"), own.bitwiseXOR(flip).alias("key"), (flip != 0).alias("flipped"))

    return F.transform(F.filter(flips, top_is_set), key)


def simhash_components(
    docs: DataFrame, width: int = 4, max_distance: int = 4, segments: int | None = None
) -> DataFrame:
    """Every row's ``doc_id, print, component_id``.

    ``component_id`` is the smallest ``doc_id`` reachable through links of at most
    ``max_distance`` differing bits, the row's own included. Rows without text have the
    fingerprint zero and link like any other. Repeated rows come back as often as they
    came in. A row without ``doc_id`` takes part and gets the component of the others;
    a group without any ``doc_id`` has a null component. An empty table gives no rows.
    Other columns of ``docs`` are not looked at.
    """
    own = cut(docs.select("doc_id", fingerprint(F.col("text"), width).alias("print")))
    prints = cut(own.groupBy("print").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")))
    joined = components(links(prints.select("print"), max_distance, segments))
    member = cut(prints.join(joined, prints["print"] == joined["node"]).select("print", "first", "component"))
    least = member.groupBy("component").agg(F.min("first").alias("component_id"))
    linked = member.join(least, "component").select("print", "component_id")
    copies = prints.filter("n > 1").join(member.select("print"), "print", "left_anti")
    shared = cut(linked.unionByName(copies.select("print", F.col("first").alias("component_id"))))
    return own.join(shared, "print", "left").select(
        "doc_id", "print", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, width: int = 4, max_distance: int = 4) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest ``doc_id``.

    Rows with the same ``doc_id`` are one document: it stays when any of its rows is the
    first of its group, and of equal repeated rows one stays. Rows without ``doc_id`` go when
    their group has a document with one; of the others one row of each fingerprint stays.
    Columns come back as they were.
    """
    found = cut(simhash_components(docs, width, max_distance))
    verdict = found.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count(F.lit(1)).alias("rows")
    )
    verdict = cut(verdict.filter("not stays or rows > 1"))
    named = docs.join(verdict.select("doc_id"), "doc_id", "left_anti").filter("doc_id is not null")
    repeated = docs.join(verdict.filter("stays").select("doc_id"), "doc_id", "left_semi")
    parts = [named.select(*docs.columns), repeated.select(*docs.columns).distinct()]
    if not found.filter("doc_id is null").isEmpty():
        unnamed = docs.filter("doc_id is null").withColumn("_print", fingerprint(F.col("text"), width))
        covered = found.filter("component_id is not null").select(F.col("print").alias("_print")).distinct()
        rest = unnamed.join(covered, "_print", "left_anti").dropDuplicates(["_print"])
        parts.append(rest.select(*docs.columns))
    kept = parts[0]
    for part in parts[1:]:
        kept = kept.unionByName(part)
    return kept
