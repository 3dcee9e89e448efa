"""Quality rules judged by host: rule failures per host, shrunk towards what hosts are like."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knockwatch.llm.store import cut

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Per document: failed when the condition holds.
RULES = {
    "few_words": f"n_words < {MIN_WORDS}",
    "repeated_words": f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words",
    "symbols": "100 * n_symbols > 50 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 14 * n_words",
}
BASE_FAILED = f"({RULES['few_words']}) or ({RULES['repeated_words']})"
#: A host is rejected when, by the shrunk rate, more than this share of its documents fails a rule.
MAX_HOST_RATE = 0.5
COUNTS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"

# White space and symbols.
_SPACE = "\x20\t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_WEIGHTS = np.random.default_rng(5).integers(1, 1 << 63, WINDOW, dtype=np.uint64) | np.uint64(1)


def _repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of eight words found twice or more."""
    places = len(words) - WINDOW + 1
    if places < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.uint64)
    sums = np.zeros(places, dtype=np.uint64)
    for j, weight in enumerate(_WEIGHTS):
        sums += (ids[j : j + places] + np.uint64(1)) * weight
    order = np.argsort(sums, kind="stable")
    same = sums[order][1:] == sums[order][:-1]
    if not same.any():
        return 0
    likely = np.zeros(places, dtype=bool)
    likely[order[1:][same]] = likely[order[:-1][same]] = True
    at = np.flatnonzero(likely)  # equal sums; the words themselves decide
    windows = ids.astype(np.int32)[at[:, None] + np.arange(WINDOW)]
    _, group, count = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    at = at[count[group.ravel()] > 1]
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + WINDOW, -1)
    return int((np.cumsum(steps) > 0).sum())


def _counts(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [line for line in text.split("\n") if line.strip(_SPACE)]
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACE)),
        sum(map(text.count, _SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        _repeat_words(words),
    )


def rule_counts(text: Column) -> Column:
    """Counts of one text as a struct; a null text counts as empty."""

    @F.pandas_udf(COUNTS)
    def of(texts: pd.Series) -> pd.DataFrame:
        names = [c.split()[0] for c in COUNTS.split(", ")]
        return pd.DataFrame([_counts(t) for t in texts], columns=names, dtype="int64")

    return of(text)


def host_verdicts(counts: DataFrame) -> DataFrame:
    """``host`` and counts per document → ``host, host_rate, host_kept``.

    For each rule the hosts' failure rates give a beta prior by their mean and variance
    (strength one where all rates are alike), and a host's rate becomes
    (failures + alpha) / (documents + alpha + beta); ``host_rate`` is the largest over the rules.
    """
    fails = {f"f_{name}": F.sum(F.expr(rule).cast("long")) for name, rule in RULES.items()}
    hosts = cut(counts.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *[e.alias(c) for c, e in fails.items()]))
    rates = {name: F.col(f"f_{name}") / F.col("n") for name in RULES}
    moments = hosts.agg(
        *[F.avg(r).alias(f"m_{name}") for name, r in rates.items()],
        *[F.var_pop(r).alias(f"v_{name}") for name, r in rates.items()],
    ).first()
    shrunk = []
    for name in RULES:
        mean, variance = moments[f"m_{name}"] or 0.0, moments[f"v_{name}"] or 0.0
        room = mean * (1 - mean)
        strength = room / variance - 1 if 1e-12 < variance < room else 1.0
        shrunk.append((F.col(f"f_{name}") + mean * strength) / (F.col("n") + strength))
    rate = F.greatest(*shrunk)
    return cut(hosts.select("host", rate.alias("host_rate"), (rate <= MAX_HOST_RATE).alias("host_kept")))


def _host(source: Column) -> Column:
    return F.coalesce(source, F.lit(""))


def _narrow(docs: DataFrame) -> DataFrame:
    counted = docs.select("doc_id", _host(F.col("source")).alias("host"), rule_counts(F.col("text")).alias("c"))
    return counted.select("doc_id", "host", "c.*")


def quality_by_host(docs: DataFrame) -> DataFrame:
    """Each row's counts and verdict: ``doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words, host_rate, base_failed, kept``.

    A document is kept when it passes the two base rules and its host is kept. A null text
    is empty (and so fails); documents without a source form one host. Repeated rows count
    as often as they occur, an empty table gives no rows, other columns are not looked at.
    """
    counts = cut(_narrow(docs))
    judged = counts.join(host_verdicts(counts), "host").withColumn("base_failed", F.expr(BASE_FAILED))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("host_kept")).drop("host", "host_kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``quality_by_host`` keeps, columns as they were.

    The texts are counted once for the hosts and once more where they are filtered, which
    is cheaper than moving them to their verdicts.
    """
    hosts = host_verdicts(cut(_narrow(docs)))
    bad = hosts.filter("not host_kept").select(F.col("host").alias("_host"))
    passed = docs.withColumn("_counts", rule_counts(F.col("text")))
    rule = BASE_FAILED
    for name in ("n_repeat_words", "n_words"):
        rule = rule.replace(name, f"_counts.{name}")
    passed = passed.filter(f"not ({rule})").withColumn("_host", _host(F.col("source")))
    return passed.join(bad, "_host", "left_anti").select(*docs.columns)
