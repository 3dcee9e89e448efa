"""Short license notices, found with a bounded number of edits.

A notice with k allowed edits is cut into k + 1 pieces; wherever it stands with at most k
edits, one piece stands unchanged. The pieces are searched exactly (all at once), and
around each find the regex library matches the whole notice with its edits bounded.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The phrases of the exact search and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Short notices (as lower-case words) and their labels.
NOTICES = [
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("licensed under the gnu general public license", "gpl"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("mozilla public license version 2 0", "mpl-2.0"),
    ("licensed under cc by sa", "cc-by-sa"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("creative commons attribution license", "cc-by"),
    ("this work is in the public domain", "public-domain"),
    ("all rights reserved", "reserved"),
]
#: One edit is allowed for so many characters of a notice.
CHARS_PER_EDIT = 15
OUTPUT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "notices array<struct<label: string, first_word: long, last_word: long, edits: int, text: string>>"
)

_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _edits(notice: str) -> int:
    return max(1, len(notice) // CHARS_PER_EDIT)


def _pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """The notice cut into ``edits + 1`` pieces of nearly equal length, with their offsets."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


@lru_cache(1)
def _search():
    """Exact search of all pieces, and the bounded-error pattern of each notice."""
    seeds: dict[str, list[tuple[int, int]]] = {}
    for number, (notice, _) in enumerate(NOTICES):
        for offset, piece in _pieces(notice, _edits(notice)):
            seeds.setdefault(piece, []).append((number, offset))
    automaton = ahocorasick.Automaton()
    for piece, uses in seeds.items():
        automaton.add_word(piece, (len(piece), uses))
    automaton.make_automaton()
    patterns = [regex.compile(f"(?b)(?:{regex.escape(n)}){{e<={_edits(n)}}}") for n, _ in NOTICES]
    return automaton, patterns


def find_notices(line: str) -> list[tuple[int, int, int, int]]:
    """Places in ``line`` (words joined by single blanks): start, end, notice number, edits.

    Only stretches in which some piece of the notice stands are matched; overlapping
    stretches of one notice are matched as one, and each stretch gives its leftmost
    non-overlapping best matches.
    """
    automaton, patterns = _search()
    spans: dict[int, list[list[int]]] = {}
    for last, (length, uses) in automaton.iter(line):
        for number, offset in uses:
            notice = NOTICES[number][0]
            edits = _edits(notice)
            start = last + 1 - length - offset - edits
            end = start + len(notice) + 2 * edits
            known = spans.setdefault(number, [])
            known.append([max(0, start), min(len(line), end)])
    found = []
    for number, stretches in spans.items():
        merged: list[list[int]] = []
        for start, end in sorted(stretches):
            if merged and start <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        for start, end in merged:
            for m in patterns[number].finditer(line, start, end):
                found.append((m.start(), m.end(), number, sum(m.fuzzy_counts)))
    return sorted(found)


def _base(line: str) -> list[tuple[int, str]]:
    """Word number and label of every place of a phrase; ``line`` has a blank at both ends."""
    places = []
    for phrase, label in PHRASES.items():
        at = line.find(f" {phrase} ")
        while at >= 0:
            places.append((line.count(" ", 0, at), label))
            at = line.find(f" {phrase} ", at + 1)
    return places


def scan(text: str | None) -> tuple:
    lowered = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
    words = _WORD.findall(lowered.decode("utf-8", "surrogatepass"))
    joined = " ".join(words)
    base = _base(f" {joined} ")
    starts = [w for w, _ in base]
    base_labels = {label for _, label in base}
    notices, best = [], 0.0
    for start, end, number, edits in find_notices(joined):
        begin = joined.count(" ", 0, start)
        best = max(best, 1 - edits / len(NOTICES[number][0]))
        notices.append((NOTICES[number][1], begin, begin + joined[start:end].strip().count(" "), edits, joined[start:end]))
    labels = base_labels | {n[0] for n in notices}
    return (
        len(words),
        len(base),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base_labels)),
        ",".join(sorted(labels)),
        1.0 if base else best,
        [dict(zip(("label", "first_word", "last_word", "edits", "text"), n)) for n in notices],
    )


def license_notices(docs: DataFrame) -> DataFrame:
    """``doc_id``, word and phrase counts, labels, a score and the notices found, for every row.

    ``score`` is 1 with an exact phrase, else the likeness (1 - edits / length) of the best
    notice, 0 without any. A null text is empty; repeated rows are scanned as often as they
    occur; an empty table gives no rows; other columns are not looked at.
    """

    @F.pandas_udf(OUTPUT)
    def scanned(texts: pd.Series) -> pd.DataFrame:
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"]
        table = pd.DataFrame([scan(t) for t in texts], columns=names)
        return table.astype({"first_word": "Int64", "last_word": "Int64"})

    return docs.select("doc_id", scanned(F.col("text")).alias("s")).select("doc_id", "s.*")
