"""Toxicity from the nearest labelled examples.

The examples (a bounded sample, both classes drawn alike) are TF-IDF vectors over all their
words, a word weighing the more the surer it tells the classes apart (likelihood ratio), in an
inverted index whose postings lie in blocks of similar examples. Words that
very many examples have are kept as full columns, so their part of every cosine is one
matrix product for a batch of texts; it also gives, for each class, a cosine that the nearest
``NEIGHBOURS`` surely reach. With it and the largest weight of each other word in each block, a
block is bounded; the postings of blocks whose bound is below that cosine are not read. The
neighbours found are those of a full comparison.

Each class votes by the cosines of its nearest examples, at several sizes of neighbourhood.
A logistic curve turns the votes into a score; it is fitted on the examples, each judged by
the others, with even odds of the classes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knockwatch.llm import textvec
from knockwatch.llm.quality_model import hash_fold

FOLDS, HELD_OUT = 3, 1
#: Bound on the labelled rows that become examples: a hash sample of about half of it from each class at most.
SAMPLE_ROWS = 8000
#: Weight of a word: (1 + log count) times this power of its log inverse document frequency.
IDF_POWER = 1.5
#: What the likelihood ratio of a word that says nothing of the classes counts as, so that no word is without weight.
NO_EVIDENCE = 0.1
#: Words that at least this share of the examples have are full columns.
FULL_SHARE = 1 / 16
NEIGHBOURS = 100
#: Sizes of neighbourhoods for votes across the classes, and within each class.
MIXED, OWN = (5, 15, 40, 100), (3, 10, 30, 100)
BLOCK = 256
SEEDS = 16
TEXTS_AT_ONCE = 128
THRESHOLD = 0.7
EVIDENCE = 3
_WORD = textvec.LETTER | textvec.DIGIT


def word_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(textvec.words(textvec.text_bytes(text), _WORD), return_counts=True)


def spread(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges from ``starts`` to ``ends`` one after the other, and the range each is of."""
    sizes = ends - starts
    which = np.repeat(np.arange(len(starts)), sizes)
    before = np.cumsum(sizes) - sizes
    return np.arange(len(which)) - before[which] + starts[which], which


@dataclass
class Index:
    """Examples: the toxic ones first, then the others; each class in blocks of similar ones."""

    ids: np.ndarray
    toxic: int  # how many are toxic
    terms: np.ndarray  # sorted word hashes
    idf: np.ndarray  # of each term: its weight
    column: np.ndarray  # of each term: its full column, or -1
    full: np.ndarray  # (example, full column) weights
    edges: np.ndarray  # where each block begins, and the end
    entry_starts: np.ndarray  # of each term: its first entry, an entry being its postings in one block
    entry_block: np.ndarray
    entry_low: np.ndarray  # of each entry: its postings
    entry_high: np.ndarray
    entry_most: np.ndarray  # and the largest weight among them
    posting_example: np.ndarray
    posting_weight: np.ndarray
    k: int = NEIGHBOURS
    read: list = field(default_factory=lambda: [0, 0])  # blocks read, of so many
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    curve: np.ndarray | None = None

    def vector(self, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and unit-length TF-IDF weights of a text; words of no example are left out."""
        return _vector(self.terms, self.idf, words, counts)

    def nearest(self, vectors: list, without: np.ndarray | None = None) -> list[tuple]:
        """For each vector the nearest examples of each class, ((numbers, cosines) of toxic ones, the same of
        others), by cosine, ties by number; only positive cosines. ``without`` is an example to leave out of each."""
        queries = np.zeros((len(vectors), self.full.shape[1]), dtype=np.float32)
        for i, (at, weights) in enumerate(vectors):
            common = self.column[at] >= 0
            queries[i, self.column[at[common]]] = weights[common]
        partial = queries @ self.full.T
        if without is not None:
            partial[np.arange(len(vectors)), without] = -np.inf
        classes = ((0, self.toxic), (self.toxic, len(self.ids)))
        least = []
        for low, high in classes:
            enough = high - low >= self.k
            least.append(np.partition(partial[:, low:high], high - low - self.k, axis=1)[:, high - low - self.k] if enough else np.full(len(vectors), -1.0))
        out = []
        own = self.edges[:-1] >= self.toxic
        for i, (at, weights) in enumerate(vectors):
            scores = partial[i]
            rare = self.column[at] < 0
            at, weights = at[rare], weights[rare]
            entries, which = spread(self.entry_starts[at], self.entry_starts[at + 1])
            blocks = self.entry_block[entries]
            bound = np.bincount(blocks, weights[which] * self.entry_most[entries], minlength=len(own)) + np.maximum.reduceat(scores, self.edges[:-1])
            # the bound is a sum in another order than the cosine: leave room for rounding
            read = bound + 1e-5 >= np.where(own, least[1][i], least[0][i])
            self.read[0] += int(read.sum())
            self.read[1] += len(read)
            entries, which = entries[read[blocks]], which[read[blocks]]
            postings, entry = spread(self.entry_low[entries], self.entry_high[entries])
            added = np.bincount(self.posting_example[postings], self.posting_weight[postings] * weights[which[entry]], minlength=len(self.ids))
            scores = np.where(np.repeat(read, np.diff(self.edges)), scores + added, 0.0)
            out.append(tuple(_best(scores[low:high], low, self.k) for low, high in classes))
        return out

    def votes(self, found: list[tuple]) -> np.ndarray:
        """Of each text: the toxic share of the cosines of its nearest, for each size of neighbourhood, and the log
        ratio of the mean cosines of the classes' nearest."""
        near = np.zeros((2, len(found), self.k))
        for i, pair in enumerate(found):
            for side, (_, cosines) in enumerate(pair):
                near[side, i, : len(cosines)] = cosines
        both = np.concatenate(near, axis=1)
        order = np.argsort(-both, axis=1, kind="stable")
        both = np.take_along_axis(both, order, axis=1)
        yes = both * (order < self.k)
        shares = [yes[:, :n].sum(axis=1) / np.maximum(both[:, :n].sum(axis=1), 1e-9) for n in MIXED]
        means = [np.maximum(near[:, :, :n].mean(axis=2), 1e-4) for n in OWN]
        return np.stack(shares + [np.log(yes_ / no) for yes_, no in means], axis=1)

    def probabilities(self, votes: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.full(len(votes), self.toxic / len(self.ids) if len(self.ids) else 0.5)
        scaled = np.concatenate(((votes - self.centre) / self.scale, np.ones((len(votes), 1))), axis=1)
        return 1 / (1 + np.exp(-np.clip(scaled @ self.curve, -30, 30)))

    def judge(self, texts: list) -> tuple[np.ndarray, list[np.ndarray]]:
        """Scores of texts, and the ids of their nearest toxic examples."""
        if not len(self.ids):
            return np.full(len(texts), 0.5), [self.ids] * len(texts)
        found = self.nearest([self.vector(*word_counts(t)) for t in texts])
        return self.probabilities(self.votes(found)), [self.ids[yes[0][:EVIDENCE]] for yes, _ in found]


def _vector(terms: np.ndarray, idf: np.ndarray, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(terms) or not len(words):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32)
    at = np.minimum(np.searchsorted(terms, words), len(terms) - 1)
    hit = terms[at] == words
    at = at[hit]
    weights = (1 + np.log(counts[hit])) * idf[at]
    norm = np.sqrt((weights**2).sum()) or 1.0
    return at, (weights / norm).astype(np.float32)


def _best(scores: np.ndarray, low: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(scores > 0)
    if len(at) > k:
        at = at[scores[at] >= np.partition(scores[at], len(at) - k)[len(at) - k]]
    at = at[np.lexsort((at, -scores[at]))[:k]]
    return at + low, scores[at]


def _logistic(votes: np.ndarray, positive: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights and offset of a logistic curve, the classes weighted alike (Newton steps, light ridge)."""
    rows = np.concatenate((votes, np.ones((len(votes), 1))), axis=1)
    worth = np.where(positive, len(positive) / (2 * positive.sum()), len(positive) / (2 * (~positive).sum()))
    penalty = np.append(np.full(votes.shape[1], ridge), 1e-6)
    curve = np.zeros(rows.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ curve, -30, 30)))
        slope = rows.T @ (worth * (p - positive)) + penalty * curve
        bend = (rows * (worth * p * (1 - p))[:, None]).T @ rows + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        curve = curve - step
        if np.abs(step).max() < 1e-8:
            break
    return curve


def _by_likeness(full: np.ndarray) -> np.ndarray:
    """An order in which examples with the same common words are neighbours: by the nearest of a few of them."""
    if not len(full):
        return np.zeros(0, dtype=np.int64)
    seeds = full[:: max(1, len(full) // SEEDS)]
    return np.argsort((full @ seeds.T).argmax(axis=1), kind="stable")


def evidence_of_words(met: np.ndarray, met_toxic: np.ndarray, toxic: int, n: int) -> np.ndarray:
    """The likelihood ratio (G) of each word, which ``met`` of ``n`` examples have, ``met_toxic`` of the ``toxic`` ones."""

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-300)), 0.0)

    other, without = n - toxic, n - met
    total = part(met_toxic, met * toxic / n) + part(met - met_toxic, met * other / n)
    total += part(toxic - met_toxic, without * toxic / n) + part(other - met + met_toxic, without * other / n)
    return np.maximum(2 * total, 0.0)


def build(ids: np.ndarray, texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, k: int = NEIGHBOURS, by_label: bool = False) -> Index:
    """Index the examples, given as word hashes and counts, and fit the curve. With ``by_label`` a word's weight is
    its TF-IDF weight times the root of its likelihood ratio, where there are examples of both classes."""
    n, labels = len(texts), np.asarray(labels, dtype=bool)
    none = np.zeros(0, dtype=np.int64)
    if not n:
        blank = np.zeros(0, dtype=np.float32)
        return Index(ids, 0, none.astype(np.uint64), blank, none, np.zeros((0, 0)), np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64), none, none, none, blank, none, blank, k)
    terms, met = np.unique(np.concatenate([w for w, _ in texts]), return_counts=True)
    idf = np.log((n + 1) / met) ** IDF_POWER
    if by_label and 0 < labels.sum() < n:
        toxic_words = np.concatenate([w for (w, _), yes in zip(texts, labels) if yes])
        met_toxic = np.bincount(np.searchsorted(terms, toxic_words), minlength=len(terms))
        idf = idf * np.sqrt(NO_EVIDENCE + evidence_of_words(met, met_toxic, int(labels.sum()), n))
    common = np.flatnonzero(met >= max(2, FULL_SHARE * n))
    column = np.full(len(terms), -1)
    column[common] = np.arange(len(common))

    vectors = [_vector(terms, idf, *t) for t in texts]
    full = np.zeros((n, len(common)), dtype=np.float32)
    for i, (at, weights) in enumerate(vectors):
        some = column[at] >= 0
        full[i, column[at[some]]] = weights[some]
    yes, no = np.flatnonzero(labels), np.flatnonzero(~labels)
    order = np.concatenate((yes[_by_likeness(full[yes])], no[_by_likeness(full[no])]))
    vectors, full = [vectors[i] for i in order], full[order]
    edges = np.unique(np.concatenate((np.arange(0, len(yes), BLOCK), np.arange(len(yes), n, BLOCK), [n])))

    example = np.repeat(np.arange(n), [len(at) for at, _ in vectors])
    term = np.concatenate([at for at, _ in vectors])
    weight = np.concatenate([w for _, w in vectors])
    rare = column[term] < 0
    by_term = np.lexsort((example[rare], term[rare]))
    example, term, weight = example[rare][by_term], term[rare][by_term], weight[rare][by_term]
    block = np.searchsorted(edges, example, side="right") - 1
    first = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])))) if len(term) else none
    index = Index(
        ids=ids[order], toxic=len(yes), terms=terms, idf=idf, column=column, full=full, edges=edges,
        entry_starts=np.searchsorted(term[first], np.arange(len(terms) + 1)), entry_block=block[first], entry_low=first,
        entry_high=np.append(first[1:], len(term)) if len(first) else none,
        entry_most=np.maximum.reduceat(weight, first) if len(first) else weight,
        posting_example=example, posting_weight=weight, k=k,
    )
    if 0 < len(yes) < n:
        found = []
        for at in range(0, n, TEXTS_AT_ONCE):
            some = np.arange(at, min(n, at + TEXTS_AT_ONCE))
            found += index.nearest([vectors[i] for i in some], without=some)
        votes = index.votes(found)
        index.centre, index.scale = votes.mean(axis=0), votes.std(axis=0) + 1e-9
        index.curve = _logistic((votes - index.centre) / index.scale, np.arange(n) < len(yes))
    return index


def sampled_examples(labels: DataFrame, label: str, bound: int) -> DataFrame:
    """``doc_id, label``, one row each: of each class a hash sample of about half of ``bound`` at most, from the
    folds that may be learned from. Where a document has several labels the largest counts."""
    fold = hash_fold(F.col("doc_id"), FOLDS)
    known = labels.filter((fold != HELD_OUT) & (fold >= 0) & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    one = known.groupBy("doc_id").agg((F.max(label) == 1).cast("int").alias("label"))
    share = F.lit(0.0)
    for kind, rows in one.groupBy("label").count().collect():  # two rows at most
        share = F.when(F.col("label") == kind, min(1.0, bound / 2 / rows)).otherwise(share)
    return one.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = SAMPLE_ROWS) -> Index:
    """The labelled sample, which is bounded, is broadcast to its texts; their words come to the driver. Where an id
    has several texts the smallest is the example."""

    @F.pandas_udf("words array<long>, counts array<long>")
    def counted(texts: pd.Series) -> pd.DataFrame:
        pairs = [word_counts(t) for t in texts]
        return pd.DataFrame({"words": [w.view(np.int64) for w, _ in pairs], "counts": [c for _, c in pairs]})

    sample = F.broadcast(sampled_examples(labels, label, bound))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(sample, "doc_id")
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    table = texts.select("doc_id", "label", counted(F.col("text")).alias("c")).select("doc_id", "label", "c.*").toArrow()
    ids = np.array(table["doc_id"].to_pylist(), dtype=object)
    words, counts = table["words"].combine_chunks(), table["counts"].combine_chunks()

    def row(i: int) -> tuple[np.ndarray, np.ndarray]:
        found = words[i].values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        return found, counts[i].values.to_numpy(zero_copy_only=False)

    order = sorted(range(len(ids)), key=lambda i: ids[i])
    return build(ids[order], [row(i) for i in order], table["label"].to_numpy()[order] == 1, by_label=True)


def toxicity_scores(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence`` for every row of ``docs``.

    ``evidence`` names the nearest toxic examples, nearest first, ties by their place in the
    index. Only the text is scored; an example is among its own neighbours, as any other text
    would be. A text without a known word (also a null or empty one) has no neighbours and
    the score of that; a text of any length is read whole. ``doc_id`` may be of any type. Rows
    without an id are scored and not held out; repeated rows are scored as often as they
    occur. Without any label every score is one half; with labels of one class, 0 or 1. An
    empty table gives no rows; other columns are not looked at.
    """
    index = docs.sparkSession.sparkContext.broadcast(train(docs, labels, bound=bound))
    kind = docs.schema["doc_id"].dataType.simpleString()

    @F.pandas_udf(f"score double, evidence array<{kind}>")
    def judged(texts: pd.Series) -> pd.DataFrame:
        scores, evidence = [np.zeros(0)], []
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            some, near = index.value.judge(list(texts.iloc[at : at + TEXTS_AT_ONCE]))
            scores.append(some)
            evidence += [list(ids) for ids in near]
        return pd.DataFrame({"score": np.concatenate(scores), "evidence": pd.Series(evidence, dtype=object)})

    fold = hash_fold(F.col("doc_id"), FOLDS)
    scored = docs.select("doc_id", (fold == HELD_OUT).alias("held_out"), judged(F.col("text")).alias("j"))
    scored = scored.select("doc_id", "held_out", "j.score", "j.evidence")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
