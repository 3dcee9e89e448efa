"""Passages repeated across documents, by MinHash banding of paragraphs.

1. One pass turns every paragraph (a line of five words or more) into its place and a digest
   of its words; the words themselves and the band hashes of their MinHash signature are
   kept once for each digest that a task meets.
2. A band hash is one number; digests meet by it in one shuffle, and those alone in their
   bucket are dropped there. Only paragraphs of crowded buckets have their words looked up.
3. In each bucket the members are verified, by exact Jaccard similarity, against its smallest
   one. Buckets whose members all link to it are done.
4. Paragraphs of other buckets are joined by an exact filter instead of in pairs: two sets
   alike to the wanted degree share one of the rarest few shingles of each. Paragraphs with
   such a shingle in common are verified in blocks of a bounded size, spread over the tasks;
   those already linked are not compared again, and only links come out.
5. Clusters are the components of all links; the first occurrence of a cluster stays.
6. Documents are linked by the paragraphs of a cluster, those of a wanted length, and by as
   many consecutive words in common wherever their lines break (``shared_runs``, MinHash over
   sliding passages); ``component_id`` is the component of these links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knockwatch.llm import textvec
from knockwatch.llm.components import components
from knockwatch.llm.lookups import found_by
from knockwatch.llm.shared_runs import run_links, to_least
from knockwatch.llm.store import cut

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.999
MOST_HASHES = 16
#: Words whose signatures are computed together, and paragraphs verified together.
WORDS_AT_ONCE, BLOCK = 1 << 18, 1024
#: Digests a task remembers, to keep the words of repeated paragraphs once; forgetting only costs space.
REMEMBERED = 1 << 18
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_NOT_SPACE = ~textvec.SPACE


def tuned_bands(similarity: float = SIMILARITY, recall: float = RECALL, most_hashes: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows of a band): the longest rows with which a pair at ``similarity`` collides with probability
    ``recall`` or more, using at most so many hashes."""
    best = (most_hashes, 1)
    for rows in range(1, most_hashes + 1):
        bands = int(np.ceil(np.log(1 - recall) / np.log1p(-(similarity**rows))))
        if bands * rows <= most_hashes:
            best = (max(1, bands), rows)
    return best


def _shingles(words: list[bytes]) -> list[bytes]:
    return [b" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))]


def shingle_hashes(paragraphs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the word shingles of paragraphs (words joined by blanks), and where each paragraph's begin."""
    data = np.frombuffer(b"\n".join(paragraphs), dtype=np.uint8)
    starts, at = textvec.runs(_NOT_SPACE[data])
    words = textvec.hash_runs(data[at], starts)
    line = np.searchsorted(np.flatnonzero(data == 10), at[starts])
    last = len(words) - SHINGLE + 1
    whole = line[SHINGLE - 1 :] == line[:last]
    hashes = np.zeros(last, dtype=np.uint64)
    for i in range(SHINGLE):
        hashes = textvec.mix(hashes + words[i : i + last] + np.uint64(i + 1))
    hashes, line = hashes[whole], line[:last][whole]
    return hashes, np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))


def signature_bands(paragraphs: list[bytes], bands: int, rows: int) -> np.ndarray:
    """(paragraph, band): one hash for each band of the MinHash signatures."""
    rng = np.random.default_rng(11)
    odd = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    salt = rng.integers(1, 1 << 63, bands, dtype=np.uint64)
    hashes, starts = shingle_hashes(paragraphs)
    out = np.empty((len(paragraphs), bands), dtype=np.uint64)
    for band in range(bands):
        key = np.full(len(paragraphs), salt[band])
        for row in range(band * rows, band * rows + rows):
            mixed = hashes * odd[row]
            least = np.minimum.reduceat(mixed ^ (mixed >> np.uint64(29)), starts)
            key = textvec.mix(key + least)
        out[:, band] = key
    return out.view(np.int64)


def jaccard(a: str, b: str) -> float:
    """Exact similarity of two paragraphs as sets of word shingles."""
    first = set(_shingles(a.encode("utf-8", "surrogatepass").split()))
    second = set(_shingles(b.encode("utf-8", "surrogatepass").split()))
    return len(first & second) / len(first | second)


def paragraphs(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """A row for each line of five words or more: ``doc_id``, where it stands (``place`` among the lines; ``start``
    and ``end`` in code points, end exclusive), ``n_words``, a 128-bit ``digest`` of its words (A-Z lower-cased).
    ``bands`` and ``words`` stand where a task first meets the digest and may stand again later."""
    bands, rows = tuned_bands(similarity)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, place int, start long, end long, n_words int, digest binary, bands array<long>, words string"
    names = [c.split()[0] for c in schema.split(", ")]

    def found(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: set[bytes] = set()
        out: list[list] = []
        new: list[tuple[int, bytes]] = []
        size = 0

        def finished() -> pd.DataFrame:
            hashes = signature_bands([joined for _, joined in new], bands, rows) if new else ()
            for (i, joined), bands_of in zip(new, hashes):
                out[i][-2:] = [bands_of, joined.decode("utf-8", "surrogatepass")]
            return pd.DataFrame(out, columns=names)

        for table in tables:
            for doc_id, text in zip(table["doc_id"], table["text"]):
                at = 0
                for place, line in enumerate((text or "").split("\n")):
                    words = line.encode("utf-8", "surrogatepass").translate(_LOWER).split()
                    if len(words) >= SHINGLE:
                        joined = b" ".join(words)
                        digest = xxhash.xxh3_128_digest(joined)
                        if digest not in met:
                            met.add(digest)
                            new.append((len(out), joined))
                            size += len(words)
                        out.append([doc_id, place, at, at + len(line), len(words), digest, None, None])
                    at += len(line) + 1
                if size > WORDS_AT_ONCE or len(out) > 20_000:
                    yield finished()
                    out, new, size = [], [], 0
                    if len(met) > REMEMBERED:
                        met.clear()
        yield finished()

    return docs.filter("doc_id is not null").select("doc_id", "text").mapInPandas(found, schema)


def _verified(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """Of the ``a, b`` digests those whose paragraphs are similar enough."""

    @F.pandas_udf("double")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([jaccard(x, y) for x, y in zip(a, b)], dtype="float64")

    first = words.select(F.col("digest").alias("a"), F.col("words").alias("words_a"))
    second = words.select(F.col("digest").alias("b"), F.col("words").alias("words_b"))
    both = pairs.join(first, "a").join(second, "b")
    return cut(both.filter(alike(F.col("words_a"), F.col("words_b")) >= similarity).select("a", "b"))


def rare_shingles(words: DataFrame, similarity: float) -> DataFrame:
    """``id, shingle`` of the rarest shingles of each paragraph (``id``, ``words``), as many as two alike paragraphs
    cannot both be without, save those no other paragraph has: they meet nothing, so they are counted and not moved.
    Rarity is that among these paragraphs; hashes break ties."""

    @F.pandas_udf("array<long>")
    def hashed(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=object)
        hashes, starts = shingle_hashes([t.encode("utf-8", "surrogatepass") for t in texts])
        return pd.Series([np.unique(h).view(np.int64) for h in np.split(hashes, starts[1:])])

    every = cut(words.select("id", hashed("words").alias("all")))
    each = every.select("id", F.size("all").alias("size"), F.explode("all").alias("shingle"))
    met = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("met")).filter("met > 1")
    own = Window.partitionBy("id")
    shared = each.join(met, "shingle").select(
        "id", "shingle", "size", F.count(F.lit(1)).over(own).alias("shared"), F.row_number().over(own.orderBy("met", "shingle")).alias("rank")
    )
    enough = F.col("size") - F.ceil(F.lit(similarity) * F.col("size") - 1e-9).cast("int") + 1
    return shared.filter(F.col("rank") + F.col("size") - F.col("shared") <= enough).select("id", "shingle")


def links_of_blocks(rare: DataFrame, lines: DataFrame, similarity: float) -> DataFrame:
    """Links ``a, b`` between similar paragraphs (``id, digest, cluster, words``) of different clusters that share one of
    their ``rare_shingles``. Words are joined only where clusters meet. A shingle with many paragraphs is cut into
    blocks by digest, and every two blocks meet once."""
    known = rare.join(lines.select("id", "digest", "cluster"), "id").drop("id")
    sizes = known.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("cluster").alias("low"), F.max("cluster").alias("high"))
    sizes = sizes.filter("low <> high").select("shingle", "n")
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int")
    dealt = cut(known.join(sizes, "shingle").withColumn("parts", parts).withColumn("own", own))
    other = F.sequence(F.lit(0), F.col("parts") - 1)
    met = dealt.join(lines.select("digest", "words"), "digest").select("shingle", "digest", "cluster", "words", "own", F.explode(other).alias("other"))
    met = met.select("shingle", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "digest", "cluster", "words")

    def compared(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, rows = None, []
        for table in tables:
            found = []
            for shingle, low, high, own, digest, cluster, line in table.itertuples(index=False, name=None):
                if (shingle, low, high) != key:
                    found += _links(rows, key is not None and key[1] != key[2], similarity)
                    key, rows = (shingle, low, high), []
                rows.append((digest, cluster, own, line))
            yield pd.DataFrame(found, columns=["a", "b"])
        yield pd.DataFrame(_links(rows, key is not None and key[1] != key[2], similarity), columns=["a", "b"])

    dealt_out = met.repartition("shingle", "low", "high").sortWithinPartitions("shingle", "low", "high")
    return dealt_out.mapInPandas(compared, "a binary, b binary")


def _links(rows: list[tuple], two_blocks: bool, similarity: float) -> list[tuple[bytes, bytes]]:
    """Links between the paragraphs (digest, cluster, block, words) of one or two blocks, until they are one cluster."""
    if len(rows) < 2:
        return []
    sets = [set(_shingles(r[3].encode("utf-8", "surrogatepass").split())) for r in rows]
    cluster = {r[1]: r[1] for r in rows}

    def root(c: bytes) -> bytes:
        while cluster[c] != c:
            c = cluster[c]
        return c

    found = []
    order = sorted(range(len(rows)), key=lambda i: len(sets[i]))
    for place, j in enumerate(order):
        b, cluster_b, own_b, _ = rows[j]
        for i in reversed(order[:place]):
            a, cluster_a, own_a, _ = rows[i]
            if len(sets[i]) < similarity * len(sets[j]) - 1e-9:
                break
            if (two_blocks and own_a == own_b) or root(cluster_a) == root(cluster_b):
                continue
            common = len(sets[i] & sets[j])
            if common >= similarity * (len(sets[i]) + len(sets[j]) - common) - 1e-9:
                found.append((a, b))
                cluster[root(cluster_a)] = root(cluster_b)
    return found


def paragraph_clusters(found: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Stored ``paragraphs`` → ``digest, cluster`` for those that are similar to another, different one."""
    some = found.filter("words is not null").withColumn("key", F.xxhash64("digest"))
    bucket = Window.partitionBy("band")
    # the one large shuffle: half a digest stands for the paragraph, and for no more than its being looked up
    banded = some.select("key", F.explode("bands").alias("band"))
    crowded = banded.select("band", "key", F.min("key").over(bucket).alias("low"), F.max("key").over(bucket).alias("high"))
    met = cut(crowded.filter("low <> high").select("band", "key").distinct())
    keys = cut(met.select("key").distinct())
    words = cut(found_by(some.select("key", "digest", "words"), keys, "key").dropDuplicates(["digest"]), "zstd")
    named = met.join(words.select("key", "digest"), "key").select("band", "digest")
    led = named.select("band", "digest", F.min("digest").over(bucket).alias("leader"), F.max("digest").over(bucket).alias("last"))
    members = cut(led.filter("leader <> last").select("band", "digest", "leader"))
    words = words.drop("key")
    to_leader = members.filter("digest <> leader").select(F.col("digest").alias("a"), F.col("leader").alias("b"))
    links = _verified(to_leader.distinct(), words, similarity)
    # what did not link to the leader of its bucket may link to others there; the least leader is a first label
    unlinked = members.filter("digest <> leader").join(links, (F.col("digest") == F.col("a")) & (F.col("leader") == F.col("b")), "left_anti")
    labels = links.groupBy(F.col("a").alias("digest")).agg(F.min("b").alias("cluster"))
    open_ = members.join(unlinked.select("band").distinct(), "band", "left_semi").select("digest").distinct()
    open_ = open_.join(labels, "digest", "left").withColumn("cluster", F.coalesce("cluster", "digest"))
    rest = cut(open_.join(words, "digest").withColumn("id", F.monotonically_increasing_id()), "zstd")
    rare = cut(rare_shingles(rest.select("id", "words"), similarity))
    links = links.unionByName(cut(links_of_blocks(rare, rest, similarity)))
    return components(links, every_step=False).select(F.col("node").alias("digest"), F.col("component").alias("cluster"))


def _occurrences(docs: DataFrame, similarity: float) -> DataFrame:
    """Every occurrence of a paragraph that another one repeats: ``doc_id, place, start, end, n_words, cluster, first``."""
    found = cut(paragraphs(docs, similarity), "zstd")
    clusters = cut(paragraph_clusters(found, similarity))
    # equal rows are one place, so a digest stands twice if its places differ
    place = F.xxhash64("doc_id", "place", "start", "end")
    keyed = found.select("doc_id", "place", "start", "end", "n_words", "digest", F.xxhash64("digest").alias("key"))
    twice = keyed.groupBy("key").agg(F.min(place).alias("low"), F.max(place).alias("high")).filter("low <> high").select("key")
    known = cut(twice.unionByName(clusters.select(F.xxhash64("digest").alias("key"))).distinct())
    places = found_by(keyed, known, "key").drop("key").distinct()
    named = cut(places.join(clusters, "digest", "left").withColumn("cluster", F.coalesce("cluster", "digest")).drop("digest"))
    firsts = named.groupBy("cluster").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count(F.lit(1)).alias("n"))
    return named.join(firsts.filter("n > 1").drop("n"), "cluster")


def repeated_paragraphs(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Every occurrence of a paragraph that another one repeats: ``doc_id, place, start, end, n_words, first_doc, removed``.

    ``first_doc`` has the first occurrence of the cluster (by ``doc_id``, then place), which is not removed.
    """
    return _with_first(_occurrences(docs, similarity))


def _with_first(occurrences: DataFrame) -> DataFrame:
    return occurrences.select(
        "doc_id", "place", "start", "end", "n_words",
        F.col("first.doc_id").alias("first_doc"),
        (F.struct("doc_id", "place") != F.col("first")).alias("removed"),
    )


def document_components(docs: DataFrame, occurrences: DataFrame, passage_words: int | None = None) -> DataFrame:
    """``doc_id, component_id`` of the documents that share a passage with another one: similar paragraphs (stored
    ``occurrences``) or, with ``passage_words``, similar paragraphs of so many words each or so many words in a row."""
    long = occurrences if passage_words is None else occurrences.filter(F.col("n_words") >= passage_words)
    links = to_least(long.select("doc_id", "cluster"), "cluster")
    if passage_words is not None:
        links = links.unionByName(run_links(docs, passage_words))
    return components(links, every_step=False).select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))


def passage_dedup(docs: DataFrame, similarity: float = SIMILARITY, passage_words: int | None = None) -> DataFrame:
    """``doc_id, n_repeated, n_removed, repeated_words, longest_repeated, component_id, repeated`` for every document.

    ``n_repeated`` counts its paragraphs that stand elsewhere too (or again), ``n_removed``
    those of them that go; ``repeated_words`` are the words of the former, ``longest_repeated``
    those of the longest; ``component_id`` is the smallest ``doc_id`` reachable over documents
    that share one of them, itself included; ``repeated`` lists them as start:end:first_doc,
    in text order. With ``passage_words`` only longer passages join documents: similar
    paragraphs of so many words each, or so many consecutive words in common, whatever lines
    they stand in (words end at white space, A-Z lower-cased; a passage twice in one document
    joins nothing). A paragraph of fewer than five words has no shingle and is left alone. Documents are told apart by ``doc_id`` (of any type that has an
    order): equal repeated rows are one; of rows that share an id but not a text, places in
    all texts count. Rows without ``doc_id`` are one document without paragraphs. A null text
    has none; a text or line of any length is read whole. Of equal first places none differ.
    An empty table gives no rows; other columns are not looked at.
    """
    occurrences = cut(_occurrences(docs, similarity))
    joined = document_components(docs, occurrences, passage_words)
    each = _with_first(occurrences).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_repeated"),
        F.count_if("removed").alias("n_removed"),
        F.sum("n_words").alias("repeated_words"),
        F.max("n_words").cast("long").alias("longest_repeated"),
        F.array_sort(F.collect_list(F.struct("start", "end", "first_doc"))).alias("all"),
    )
    ids = docs.select("doc_id").distinct()
    text: Column = F.array_join(F.transform("all", lambda s: F.concat_ws(":", s["start"], s["end"], s["first_doc"])), ",")
    counts = ["n_repeated", "n_removed", "repeated_words", "longest_repeated"]
    return ids.join(each, "doc_id", "left").join(joined, "doc_id", "left").select(
        "doc_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(text, F.lit("")).alias("repeated"),
    )
