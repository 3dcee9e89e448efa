"""Benchmark passages inside documents, found by winnowing.

A window of ``LENGTH`` words is known by the smallest hash of the ``GRAM``-word sequences in
it, so every shared window, and with it every shared span of that length or more, has a
fingerprint in both tables. Documents keep the windows whose fingerprint is, by a bitmap of
bounded size, likely in the benchmark; these join the benchmark's fingerprints, and each hit
is extended to its whole window, word for word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knockwatch.llm.native import let, places, words
from knockwatch.llm.store import cut

LENGTH = 10
GRAM = 5
#: Places in the bitmap for each fingerprint, and the most places it may have (1 MB).
BITS_EACH, MOST_BITS = 32, 1 << 20


def _run(array: Column, at: Column, length: int) -> list[Column]:
    """Elements ``at`` (from 1) and after, one by one: ``slice`` would copy the whole array each time."""
    return [F.get(array, at + j) for j in range(-1, length - 1)]


def _print_of(grams: Column, at: Column) -> Column:
    return F.least(*_run(grams, at, LENGTH - GRAM + 1))


def _grams(tokens: Column) -> Column:
    return F.transform(places(F.size(tokens) - GRAM + 1), lambda i: F.xxhash64(*_run(tokens, i, GRAM)))


def _window(tokens: Column, at: Column, length: Column, fingerprint: Column) -> Column:
    """A window of at most ``LENGTH`` words; places after its end are null, which joining skips."""
    inside = [F.when(length > j, w) for j, w in enumerate(_run(tokens, at, LENGTH))]
    return F.struct(
        at.alias("start"),
        length.alias("length"),
        fingerprint.alias("print"),
        F.concat_ws(" ", *inside).alias("window"),
    )


def _short_print(tokens: Column, at: Column, length: Column) -> Column:
    return F.xxhash64(*[F.when(length > j, w) for j, w in enumerate(_run(tokens, at, LENGTH - 1))])


def _all_windows(tokens: Column) -> Column:
    """Every window of an item: runs of ``LENGTH`` words, or all words of a shorter item."""
    whole = F.array(_window(tokens, F.lit(1), F.size(tokens), _short_print(tokens, F.lit(1), F.size(tokens))))
    many = let(
        _grams(tokens),
        lambda g: F.transform(
            places(F.size(tokens) - LENGTH + 1), lambda i: _window(tokens, i, F.lit(LENGTH), _print_of(g, i))
        ),
    )
    return F.when(F.size(tokens) >= LENGTH, many).when(F.size(tokens) > 0, whole)


def _likely_windows(tokens: Column, bitmap: Column, bits: int, short: Column) -> Column:
    """The windows of a document whose fingerprint has its bit in the bitmap."""

    def likely(fingerprint: Column) -> Column:
        return F.get(bitmap, fingerprint.bitwiseAND(F.lit(bits - 1)).cast("int"))

    def found(length: Column, fingerprint) -> Column:
        at = F.filter(places(F.size(tokens) - length + 1), lambda i: likely(fingerprint(i)))
        return F.transform(at, lambda i: _window(tokens, i, length, fingerprint(i)))

    full = let(_grams(tokens), lambda g: found(F.lit(LENGTH), lambda i: _print_of(g, i)))
    less = F.flatten(F.transform(short, lambda n: found(n, lambda i: _short_print(tokens, i, n))))
    return F.concat(full, less)


def _bitmap(prints: DataFrame, bits: int) -> DataFrame:
    """One row: an array of booleans, true at the place of every fingerprint."""
    place = F.col("print").bitwiseAND(F.lit(bits - 1)).alias("id")
    every = prints.sparkSession.range(bits).select("id", F.lit(False).alias("met"))
    met = every.unionByName(prints.select(place, F.lit(True).alias("met"))).groupBy("id").agg(F.max("met").alias("met"))
    return met.agg(F.array_sort(F.collect_list(F.struct("id", "met"))).alias("all")).select(F.col("all.met").alias("bits"))


def _item_windows(items: DataFrame) -> DataFrame:
    """``item_id, length, print, window``, each once."""
    tokens = let(words(F.col("text")), _all_windows)
    return items.select("item_id", F.inline(tokens)).drop("start").distinct()


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs``.

    A word is hit inside any occurrence of a window of any item. Null and empty texts have no
    words; items without words have no windows; repeated items and items without an id
    count by their windows (an item without an id is in no list). Repeated rows come back as often as they
    came in, told apart by ``doc_id`` and ``text_hash``. An empty table of items hits nothing,
    an empty table of documents gives no rows. Other columns are not looked at.
    """
    windows = cut(_item_windows(items.select("item_id", "text")))
    known = windows.select("length", "print", "window").distinct()
    bits = 1 << 12
    while bits < min(MOST_BITS, BITS_EACH * windows.select("print").distinct().count()):
        bits *= 2
    bitmap = cut(_bitmap(windows.select("print").distinct(), bits)).select("bits").scalar()
    short = windows.filter(F.col("length") < LENGTH).agg(F.array_sort(F.collect_set("length"))).scalar()
    # subqueries may not stand inside a lambda: they are columns first
    known_bits = docs.select("doc_id", "text", bitmap.alias("bitmap"), short.alias("short"))
    read = known_bits.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        let(
            words(F.col("text")),
            lambda t: F.struct(
                F.size(t).cast("long").alias("n_words"), _likely_windows(t, F.col("bitmap"), bits, F.col("short")).alias("likely")
            ),
        ).alias("r"),
    )
    read = cut(read.select("doc_id", "text_hash", "r.n_words", "r.likely"))
    likely = read.filter(F.size("likely") > 0).select("doc_id", "text_hash", F.inline("likely")).distinct()
    hits = cut(likely.join(known, ["length", "print", "window"]))
    spans = hits.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("spans")
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["end"], s["start"]))).alias("n"),
            F.greatest(a["end"], s["end"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    named = hits.select("doc_id", "text_hash", "print", "window").distinct().join(
        windows.filter("item_id is not null").select("item_id", "print", "window"), ["print", "window"]
    )
    listed = named.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    found = _null_safe_left(spans.select("doc_id", "text_hash", covered.alias("n_hit")), listed)
    found = _null_safe_left(read.select("doc_id", "text_hash", "n_words"), found)
    none = F.array().cast("array<string>")
    return found.select(
        "doc_id",
        "text_hash",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size(F.coalesce("items", none)), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def _null_safe_left(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on ``doc_id`` (null equals null) and ``text_hash``."""
    other = right.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    return left.join(other, on, "left").drop("_id", "_hash")


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any hit word; columns as they were, whatever they are called."""
    bad = contamination(docs, items).filter("contaminated")
    bad = cut(bad.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct())
    # the row stays in one column while it meets others
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    on = F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("row.text") == F.col("_hash"))
    return rows.join(bad, on, "left_anti").select("row.*")
