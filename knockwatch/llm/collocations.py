"""Phrases whose words belong together, counted in counting quotient filters.

1. Tasks cut their texts into blocks of some megabytes; a block is stored once, as codes
   into its own list of distinct words. Only those lists are shuffled: they add up to the
   vocabulary, in which every word that is frequent enough gets a dense id.
2. Each block gets the ids of its words back, packs every run of two and more ids and counts
   them in a quotient filter. A rarer word breaks a run, as punctuation does: no phrase with
   it can be frequent enough.
3. The filters, cut by their leading bits, meet by range and merge one after the other. A
   common phrase is one entry of each block, however often it stands there.
4. Phrases that are frequent enough are read back from the filters, since the permutation is
   invertible, and scored by joins with the counts of their parts, in exact decimals.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knockwatch.llm import quotient_filter as qf
from knockwatch.llm.store import cut

MIN_COUNT = 10
LONGEST = 3
TOP = 2000
SCALE = 1_000_000
#: A candidate goes when a longer one has this share of its count, in percent.
COVERED_PERCENT = 50
#: Bytes of text a block has at most, apart from a single longer text.
BLOCK_BYTES = 8 << 20
#: Entries a range of filters may have: an upper bound, since it counts every n-gram of the corpus.
RANGE_ENTRIES = 1 << 20
#: Parts in which the vocabulary is numbered.
PARTS = 256
BLOCKS = "block long, lang string, codes binary, code_bytes int, words array<binary>, counts array<long>"
_TABLE = bytearray(c + 32 if 65 <= c <= 90 else c for c in range(256))
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = 10
_TABLE = bytes(_TABLE)
_BREAK = b"\xff"  # never a byte of UTF-8


def coded(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Texts as codes (0: a break between pieces), the words of codes 1, 2, ... and their counts."""
    data = b"\n".join(texts).translate(_TABLE).replace(b"\n", b" \xff ")
    code: dict[bytes, int] = defaultdict(count().__next__)
    code[_BREAK]
    tokens = data.split(b" ") if b"\t" not in data else data.replace(b"\t", b" ").split(b" ")
    codes = np.fromiter(map(code.__getitem__, filter(None, tokens)), dtype=np.int64)
    words = list(code)[1:]
    return codes, words, np.bincount(codes, minlength=len(words) + 1)[1:]


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (``lang``, ``text``) as coded blocks of one language each."""

    def row(lang: str, texts: list[bytes], number: int) -> dict:
        codes, words, counts = coded(texts)
        size = 2 if len(words) < 1 << 16 else 4
        return {
            "block": (TaskContext.get().partitionId() << 32) + number, "lang": lang,
            "codes": codes.astype(f"<u{size}").tobytes(), "code_bytes": size, "words": words, "counts": counts,
        }

    def found(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        number = count()

        def flush(lang: str) -> pd.DataFrame:
            del sizes[lang]
            return pd.DataFrame([row(lang, waiting.pop(lang), next(number))])

        for table in tables:
            for lang, text in zip(table["lang"], table["text"]):
                data = text.encode("utf-8", "surrogatepass")
                if sizes.get(lang, 0) + len(data) > block_bytes and lang in sizes:
                    yield flush(lang)
                waiting.setdefault(lang, []).append(data)
                sizes[lang] = sizes.get(lang, 0) + len(data)
                if sum(sizes.values()) > 2 * block_bytes:
                    yield flush(max(sizes, key=sizes.get))
        for lang in list(waiting):
            yield flush(lang)

    known = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").filter("text is not null")
    return known.mapInPandas(found, BLOCKS)


def _local_words(coded_blocks: DataFrame) -> DataFrame:
    """A row for each distinct word of each block."""
    pairs = F.posexplode(F.arrays_zip("words", "counts")).alias("at", "word")
    rows = coded_blocks.select("block", "lang", pairs)
    return rows.select(
        "block", "lang", (F.col("at") + 1).alias("code"), F.col("word.words").alias("word"), F.col("word.counts").alias("n")
    )


def vocabulary(local: DataFrame, min_count: int) -> DataFrame:
    """``lang, word, f, id`` of the words that are frequent enough, numbered from 1 without a gap."""
    part = F.pmod(F.xxhash64("lang", "word"), F.lit(PARTS)).alias("part")
    frequent = local.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= min_count)
    frequent = cut(frequent.select("*", part))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = frequent.groupBy("part").agg(F.count(F.lit(1)).alias("size"))  # a row for each part at most
    starts = starts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("lang", "word"))
    numbered = frequent.join(F.broadcast(starts), "part")
    return numbered.select("lang", "word", "f", (F.col("start") + place).alias("id"))


def ngram_filters(
    coded_blocks: DataFrame, ids: DataFrame, id_bits: int, range_bits: int, longest: int = LONGEST
) -> DataFrame:
    """``range, filter``: the filters of each block, cut into ranges of their leading bits.

    ``ids`` has, for each block, the array of its words' ids, 0 for a word without one.
    """
    width = qf.half_width(longest, id_bits)

    def of(codes: bytes, size: int, known: np.ndarray) -> qf.Entries:
        text = np.concatenate(([0], known))[np.frombuffer(codes, dtype=f"<u{size}")]
        inside = text > 0
        filters = []
        for length in range(2, longest + 1):
            inside = inside[:-1] & (text[length - 1 :] > 0) if len(inside) else inside
            at = np.flatnonzero(inside)
            columns = [text[at + i] if i < length else np.zeros(len(at), dtype=np.int64) for i in range(longest)]
            filters.append(qf.permute(*qf.pack(columns, id_bits, width), width))
        left, right = (np.concatenate(halves) for halves in zip(*filters))
        return qf.counted(left, right, width)

    def found(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in tables:
            for codes, size, known in zip(table["codes"], table["code_bytes"], table["ids"]):
                entries = of(codes, size, np.asarray(known, dtype=np.int64))
                edges = qf.ranges(entries, range_bits, width)
                parts = [(i, qf.encode(entries.part(a, b), width, range_bits)) for i, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
                yield pd.DataFrame(parts, columns=["range", "filter"])

    both = coded_blocks.select("block", "codes", "code_bytes").join(ids, "block")
    return both.select("codes", "code_bytes", "ids").mapInPandas(found, "range int, filter binary")


def frequent_ngrams(filters: DataFrame, id_bits: int, min_count: int, longest: int = LONGEST) -> DataFrame:
    """``ids, f`` of the n-grams that are frequent enough, from all filters of a range."""
    width = qf.half_width(longest, id_bits)

    def found(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, total, waiting, pending = None, qf.nothing(), [], 0

        def finished() -> pd.DataFrame:
            entries = qf.merged([total, *waiting], width)
            kept = entries.counts >= min_count
            columns = qf.unpack(*qf.restore(entries.left[kept], entries.right[kept], width), longest, id_bits, width)
            ids = np.stack(columns, axis=1) if kept.any() else np.zeros((0, longest), dtype=np.int64)
            return pd.DataFrame({"ids": pd.Series([row[row > 0] for row in ids], dtype=object), "f": entries.counts[kept]})

        for table in tables:
            for number, data in zip(table["range"], table["filter"]):
                if number != current:
                    if current is not None:
                        yield finished()
                    current, total, waiting, pending = number, qf.nothing(), [], 0
                waiting.append(qf.decode(data, width))
                pending += len(waiting[-1])
                if pending > max(RANGE_ENTRIES // 4, len(total)):
                    total, waiting, pending = qf.merged([total, *waiting], width), [], 0
        if current is not None:
            yield finished()

    together = filters.repartition("range").sortWithinPartitions("range")
    return together.mapInPandas(found, "ids array<long>, f long")


def _ids_of_blocks(local: DataFrame, words: DataFrame) -> DataFrame:
    """``block, ids``: for each block an array of its words' ids; its size is that of the block's word list."""
    known = local.join(words.select("lang", "word", "id"), ["lang", "word"], "left")
    pair = F.struct("code", F.coalesce("id", F.lit(0).cast("long")).alias("id"))
    return known.groupBy("block").agg(F.array_sort(F.collect_list(pair)).alias("all")).select("block", F.col("all.id").alias("ids"))


def _bits_for(most: int) -> int:
    return max(1, int(most).bit_length())


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """Word occurrences per language (``lang, n``), the frequent phrases of 1 to ``longest`` words
    (``ids, f``, single words also with ``lang`` and ``phrase``), and the block table."""
    stored = cut(blocks(docs))
    local = _local_words(stored)
    words = cut(vocabulary(local, min_count))
    totals = cut(local.groupBy("lang").agg(F.sum("n").alias("n")))
    id_bits = _bits_for(words.count())
    tokens = totals.agg(F.sum("n")).first()[0] or 0
    range_bits = min(_bits_for((longest - 1) * tokens // RANGE_ENTRIES), qf.half_width(longest, id_bits))
    ids = cut(_ids_of_blocks(local, words))
    filters = cut(ngram_filters(stored, ids, id_bits, range_bits, longest))
    found = cut(frequent_ngrams(filters, id_bits, min_count, longest))
    single = words.select(F.array("id").alias("ids"), "f", "lang", F.col("word").cast("string").alias("phrase"))
    levels = [single] + [found.filter(F.size("ids") == m) for m in range(2, longest + 1)]
    return totals, levels, stored


def _head(k: int) -> Column:
    return F.slice("ids", 1, k)


def _tail(length: int, k: int) -> Column:
    return F.slice("ids", k + 1, length - k)


def scored_phrases(levels: list[DataFrame]) -> DataFrame:
    """Every frequent phrase of two and more words with its lowest-scoring cut: ``ids, lang, phrase, a, l, r, score``.

    A phrase shorter by one word is frequent whenever the phrase is, so its text and its
    count are there to join; of equal scores the cut after fewer words counts.
    """
    known = {1: levels[0]}
    parts = []
    for length in range(2, len(levels) + 1):
        table = levels[length - 1]
        for k in range(1, length):
            left = known[k].select(F.col("ids").alias("head"), F.col("f").alias(f"l{k}"), F.col("lang").alias(f"lang{k}"), F.col("phrase").alias(f"head{k}"))
            right = known[length - k].select(F.col("ids").alias("tail"), F.col("f").alias(f"r{k}"), F.col("phrase").alias(f"tail{k}"))
            table = table.join(left, _head(k) == F.col("head")).drop("head").join(right, _tail(length, k) == F.col("tail")).drop("tail")
        a, wide = F.col("f").cast("decimal(15,0)"), "decimal(15,0)"

        def cut_at(k: int) -> Column:
            above = (F.lit(SCALE).cast("decimal(8,0)") * (a * a).cast("decimal(30,0)")).cast("decimal(38,0)")
            below = F.col(f"l{k}").cast(wide) * F.col(f"r{k}").cast(wide)
            score = F.call_function("div", above, below.cast("decimal(30,0)"))
            return F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))

        best = F.array_min(F.array(*[cut_at(k) for k in range(1, length)]))
        table = table.select("ids", F.col("lang1").alias("lang"), F.concat("head1", F.lit(" "), "tail1").alias("phrase"), "f", best.alias("best"))
        table = cut(table)
        known[length] = table
        parts.append(table.select("ids", "lang", "phrase", F.col("f").alias("a"), "best.l", "best.r", "best.score"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def without_covered(phrases: DataFrame, longest: int = LONGEST, percent: int = COVERED_PERCENT) -> DataFrame:
    """``phrases`` without those that stand inside a longer one which has the given share of their count."""
    size = F.size("ids")
    runs = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda at: F.slice("ids", at, n)),
        )
    )
    inside = phrases.filter(size > 2).select(F.explode(runs).alias("part"), F.col("a").alias("longer"))
    inside = inside.groupBy("part").agg(F.max("longer").alias("longer"))
    joined = phrases.join(inside, F.col("ids") == F.col("part"), "left")
    return joined.filter(f"longer is null or 100 * longer < {percent} * a").drop("part", "longer")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its two parts at the cut with the
    lowest score (after flooring; the first of equals), ``n`` the words of the language. A
    null language is ``und``; null and empty texts have no words; repeated rows count as
    often as they stand there; equal scores are ordered by ``a``, then by phrase. Texts of
    any length are read whole: a text longer than a block is a block. Other columns are not
    looked at, also not ids. An empty table gives no rows.
    """
    totals, levels, _ = phrase_counts(docs, min_count, longest)
    kept = without_covered(scored_phrases(levels), longest)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
