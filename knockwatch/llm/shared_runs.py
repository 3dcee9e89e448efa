"""Runs of words that documents share, wherever their lines begin: sliding passages by their MinHash.

1. Every passage of ``size`` consecutive words is marked by the least hash of its shingles (a third
   as long): a MinHash of one row, which equal passages have in common and neighbours mostly
   share. One row is kept for each stretch of neighbours with the same mark, with a digest
   of all its words.
2. Marks of one document only are dropped. Documents with the same stretch are linked to its least one.
3. Where stretches differ though their mark is the same, and their documents are not linked to one document by
   now, the passages of one document for each stretch are written out and meet by their digests. So the components
   are those of all documents that share ``size`` words in a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knockwatch.llm import textvec
from knockwatch.llm.lookups import BROADCAST_ROWS, found_by
from knockwatch.llm.store import cut

#: Bytes of texts that are hashed together.
BYTES_AT_ONCE = 1 << 22
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _over(values: np.ndarray, size: int, both) -> np.ndarray:
    """``both`` over every ``size`` neighbours, by doubling."""
    out, done, length = None, 0, 1
    while True:
        if size & length:
            out = values if out is None else both(out[: len(values) - done], values[done:])
            done += length
        if 2 * length > size:
            return out
        values = both(values[:-length], values[length:])
        length *= 2


def _ordered(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return textvec.mix(a * _ODD + b)


def stretches(texts: list[bytes], size: int) -> tuple[np.ndarray, ...]:
    """Of the passages of ``size`` words of texts: (digest of each passage; for each stretch of neighbours with the
    same mark its text, first passage, mark and digest). A-Z are lower-cased."""
    data = textvec.LOWER[np.frombuffer(b"\n".join(texts), dtype=np.uint8)]
    begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    starts, at = textvec.runs(~textvec.SPACE[data])
    none = np.zeros(0, dtype=np.int64)
    if len(starts) < size:
        return none.view(np.uint64), none, none, none.view(np.uint64), none.view(np.uint64)
    of = np.searchsorted(begins, at[starts], side="right") - 1
    words = textvec.hash_runs(data[at], starts)
    shingle = max(1, size // 3)
    marks = _over(_over(words, shingle, _ordered), size - shingle + 1, np.minimum)
    whole = of[: len(marks)] == of[size - 1 :]
    digests, marks, of = _over(words, size, _ordered)[whole], marks[whole], of[: len(marks)][whole]
    if not len(of):
        return digests, none, none, marks, digests
    first = np.flatnonzero(np.concatenate(([True], (marks[1:] != marks[:-1]) | (of[1:] != of[:-1]))))
    place = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
    return digests, of[first], first, marks[first], np.add.reduceat(textvec.mix(digests + place.astype(np.uint64) * _ODD), first)


def _batches(tables: Iterator[pd.DataFrame], *columns: str) -> Iterator[tuple[list, ...]]:
    """Values of ``columns`` and the encoded texts, some rows at a time."""
    held: list[tuple] = []
    size = 0
    for table in tables:
        for *values, text in zip(*(table[c] for c in columns), table["text"]):
            held.append((*values, (text or "").encode("utf-8", "surrogatepass")))
            size += len(held[-1][-1])
            if size > BYTES_AT_ONCE:
                yield tuple(map(list, zip(*held)))
                held, size = [], 0
    if held:
        yield tuple(map(list, zip(*held)))


def marked_stretches(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, mark, stretch, new``: the distinct stretches of each text; ``new`` once for each of its marks."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def found(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, texts in _batches(tables, "doc_id"):
            _, of, _, mark, stretch = stretches(texts, size)
            order = np.lexsort((stretch, mark, of))
            of, mark, stretch = of[order], mark[order], stretch[order]
            new = np.ones(len(of), dtype=bool)
            new[1:] = (of[1:] != of[:-1]) | (mark[1:] != mark[:-1])
            other = new.copy()
            other[1:] |= stretch[1:] != stretch[:-1]
            doc = pd.Series([ids[i] for i in of[other]], dtype=object)
            yield pd.DataFrame({"doc_id": doc, "mark": mark[other].view(np.int64), "stretch": stretch[other].view(np.int64), "new": new[other]})

    schema = f"doc_id {kind}, mark long, stretch long, new boolean"
    return docs.filter("doc_id is not null").select("doc_id", "text").mapInPandas(found, schema)


def passages_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``doc_id, mark, passage``: every passage of the stretches listed in ``wanted`` (``doc_id, stretches``)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def found(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, lists, texts in _batches(tables, "doc_id", "stretches"):
            digests, of, first, mark, stretch = stretches(texts, size)
            asked = np.concatenate([np.asarray(x, dtype=np.int64) for x in lists]).view(np.uint64)
            taken = np.isin(stretch, asked)
            lengths = np.diff(np.append(first, len(digests)))
            passage = digests[np.repeat(taken, lengths)]
            of, mark = np.repeat(of[taken], lengths[taken]), np.repeat(mark[taken], lengths[taken])
            order = np.lexsort((passage, of))
            of, mark, passage = of[order], mark[order], passage[order]
            other = np.ones(len(of), dtype=bool)
            other[1:] = (of[1:] != of[:-1]) | (passage[1:] != passage[:-1])
            doc = pd.Series([ids[i] for i in of[other]], dtype=object)
            yield pd.DataFrame({"doc_id": doc, "mark": mark[other].view(np.int64), "passage": passage[other].view(np.int64)})

    texts = found_by(docs.select("doc_id", "text"), wanted, "doc_id")
    return texts.mapInPandas(found, f"doc_id {kind}, mark long, passage long")


def to_least(held: DataFrame, *keys: str) -> DataFrame:
    """Links ``a, b`` from each ``doc_id`` to the least one that has the same ``keys``."""
    least = held.groupBy(*keys).agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("last"))
    least = cut(least.filter("b < last").drop("last"))
    least = F.broadcast(least) if least.count() <= BROADCAST_ROWS else least
    return held.join(least, [*keys]).filter("doc_id > b").select(F.col("doc_id").alias("a"), "b").distinct()


def run_links(docs: DataFrame, size: int) -> DataFrame:
    """Links ``a, b`` between documents (``doc_id, text``), whose components are those of all documents that have ``size``
    or more consecutive words in common. A passage repeated within one document links nothing; rows without a
    ``doc_id`` take no part, and rows that share one are one document."""
    every = cut(marked_stretches(docs, size))
    crowded = cut(every.filter("new").groupBy("mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("mark"))
    held = cut(found_by(every.drop("new"), crowded, "mark"))
    whole = cut(to_least(held, "mark", "stretch"))
    # documents linked to the same one need not meet again
    linked = whole.groupBy(F.col("a").alias("doc_id")).agg(F.min("b").alias("b"))
    one_each = held.groupBy("mark", "stretch").agg(F.min("doc_id").alias("doc_id"))
    labelled = cut(one_each.join(linked, "doc_id", "left").withColumn("label", F.coalesce("b", "doc_id")).drop("b"))
    apart = labelled.groupBy("mark").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("mark")
    wanted = cut(labelled.join(apart, "mark").groupBy("doc_id").agg(F.collect_set("stretch").alias("stretches")))
    passages = cut(passages_of(docs, wanted, size))
    return whole.unionByName(cut(to_least(passages, "mark", "passage")))
