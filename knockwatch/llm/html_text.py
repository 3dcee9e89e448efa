"""Main text of web pages by rules on blocks, in two passes.

The first pass decides blocks by link density, length and stop-word density; what is
marked as menu, form, advert and the like is out before. Blocks too short to tell then
take the label of the nearest decided block.

Running text has function words: a long block with hardly any is no article, unless it stands in
an article or main element, or the whole page has none, being in a language the list lacks.
"""

from __future__ import annotations

import html
import re
from bisect import bisect
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONG_WORDS = 25
STOP_WORDS_AT_LEAST = 8
STOP_DENSITY = 0.25
#: A long block outside the main element is out below this share of function words; a page below it is in another language.
LOW_STOP_DENSITY = 0.04
#: A main element is a teaser when the other blocks have so many words, and so many times as many as it.
TEASER_WORDS, TEASER_TIMES = 100, 4
MAX_LINK_DENSITY = 0.33

# Function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "a an and are as at be but by for from has have he her his i in is it its not of on or she that the their they "
    "this to was we were which who will with you "
    "aber als am auch auf aus bei das dem den der des die ein eine einer er es für hat ich im ist mit nach nicht noch "
    "oder sich sie sind über um und von vor war wie wir zu zum zur "
    "au aux avec ce cette dans de des du elle en est et il ils je la le les leur mais ne nous ou par pas plus pour que "
    "qui sa se ses son sur un une vous "
    "al como con del desde el ella entre era esta este fue ha hay las lo los más muy no o para pero por se sin sobre su "
    "sus también una uno y ya".split()
)
# Element names.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html iframe li main menu nav ol optgroup option p pre section select "
    "summary table tbody td textarea tfoot th thead title tr ul".split()
)
DROPPED = frozenset("aside button dialog footer form head iframe menu nav optgroup option select textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_ITSELF = frozenset("dd dt li option p td th tr".split())
MAIN = frozenset(("article", "main"))
# Words in class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments complementary "
    "consent contentinfo cookie cookies copyright dialog discussion disqus disclaimer footer gdpr hidden legal login "
    "masthead menu modal nav navbar navigation newsletter notice notification overlay pager pagination popup promo "
    "promoted recommended related replies reply respond search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe toolbar widget".split()
)
HEADS = frozenset(("header",))  # out unless inside the main element

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|math|canvas|object|audio|video)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_UNSEEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORD = re.compile(r"\w+")


def _marked(attributes: str) -> bool:
    if not attributes or attributes.isspace():
        return False
    if _UNSEEN.search(attributes):
        return True
    for _, *values in _NAMED.findall(attributes):
        if MARKS & set(re.split(r"[\s_-]+", "".join(values).lower())):
            return True
    return False


def blocks(page: str) -> list[tuple[str, int, bool]]:
    """``(text, characters inside links, inside a main element)`` of each block with text
    that no mark-up rules out, in page order."""
    found: list[tuple[str, int, bool]] = []
    pieces: list[str] = []
    linked = 0
    stack: list[tuple[str, bool]] = []  # open block elements, and whether they are out
    is_open: Counter[str] = Counter()  # how many of each name are open
    out = main = 0
    link: int | None = None  # how many elements were open where the open link began: it ends with the innermost of them

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text and not out:
            found.append((text, min(linked, len(text)), main > 0))
        pieces.clear()
        linked = 0

    def pop() -> None:
        nonlocal out, main, link
        name, was_out = stack.pop()
        is_open[name] -= 1
        out -= was_out
        main -= name in MAIN
        if link is not None and len(stack) < link:
            link = None

    def pop_to(name: str) -> None:
        while stack[-1][0] != name:
            pop()
        pop()

    def text(raw: str) -> None:
        nonlocal linked
        if raw:
            plain = html.unescape(raw)
            pieces.append(plain)
            if link is not None:
                linked += len("".join(plain.split()))

    at = 0
    for tag in _TAG.finditer(page):
        text(page[at : tag.start()])
        at = tag.end()
        name = (tag[3] or tag[6] or "").lower()
        if not name:
            continue
        closing = bool(tag[2] or tag[5])
        if name == "a":
            link = None if closing else len(stack)
        elif name == "br":
            pieces.append(" ")
        elif name in BLOCK or (not closing and name not in VOID and _marked(tag[4] or tag[7] or "")):
            close()
            if closing:
                if is_open[name]:
                    pop_to(name)
            elif name not in VOID:
                if name in CLOSES_ITSELF and stack and stack[-1][0] == name:
                    pop()
                attributes = tag[4] or tag[7] or ""
                gone = name in DROPPED or _marked(attributes) or (name in HEADS and not main)
                stack.append((name, gone))
                is_open[name] += 1
                out += gone
                main += name in MAIN
        elif closing and is_open[name]:
            close()
            pop_to(name)
    text(page[at:])
    close()
    return found


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _stop_words(words: list[str]) -> int:
    return sum(w in STOP_WORDS for w in words)


def first_label(text: str, linked: int, needs_stop_words: bool) -> bool | None:
    """True: article; False: not; None: too short or too odd to tell."""
    if linked > MAX_LINK_DENSITY * len("".join(text.split())):
        return False
    words = _words(text)
    stop = _stop_words(words)
    if len(words) >= LONG_WORDS:
        return not needs_stop_words or stop >= LOW_STOP_DENSITY * len(words)
    if len(words) >= STOP_WORDS_AT_LEAST and stop >= STOP_DENSITY * len(words):
        return True
    return None


def inherited(labels: list[bool | None]) -> list[bool]:
    """Undecided labels become that of the nearest decided one; at equal distance, and where none is decided, True."""
    decided = [i for i, label in enumerate(labels) if label is not None]
    out = []
    for i, label in enumerate(labels):
        if label is None:
            after = bisect(decided, i)
            around = decided[max(0, after - 1) : after + 1]
            near = min((abs(i - d) for d in around), default=0)
            label = any(labels[d] for d in around if abs(i - d) == near) if around else True
        out.append(label)
    return out


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    sizes = [len(_words(text)) for text, _, _ in found]
    own = sum(n for n, b in zip(sizes, found) if b[2])
    rest = sum(sizes) - own
    if any(b[2] for b in found) and not (rest >= TEASER_WORDS and rest >= TEASER_TIMES * own):
        found = [b for b in found if b[2]]
    every = [w for text, _, _ in found for w in _words(text)]
    known = _stop_words(every) >= LOW_STOP_DENSITY * len(every)
    labels = inherited([first_label(text, linked, known and not inside) for text, linked, inside in found])
    return "\n\n".join(text for (text, _, _), label in zip(found, labels) if label)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    With an ``article`` or ``main`` element only its blocks count, unless it is a mere teaser. A
    block takes the label of the nearest decided block; at equal distance article wins, and
    where nothing is decided every block stays. A null or empty page has the empty text;
    broken or cut mark-up ends where the page ends, a link left open with the element it is in;
    a page of any length is read whole, in proportion to its length; repeated rows come back
    as often; an empty table gives no rows. Other columns are not looked at.
    """

    @F.pandas_udf("string")
    def extracted(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages], dtype="object")

    found = pages.select("page_id", "url", extracted(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
