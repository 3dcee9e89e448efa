"""Each operator against a brute-force version, on a small corpus of its own making."""

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from knockwatch.llm import (
    decontaminate, host_rules, html_text, license_scan, lookups, mixing, paragraph_dedup, pii, quality_model, shared_runs, simhash, toxicity,
)
from knockwatch.llm.components import components
from knockwatch.llm.queries import levels, weights

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label string, host string, node int"
ITEMS = "item_id long, text string, label string"
A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def sentence(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta omega sigma kappa rho tau phi".split()) + str(rng.randrange(40)) for _ in range(n))


def corpus():
    """Plain, copied, nearly copied, empty, null, long and repeated documents, and some without an id."""
    rng = random.Random(4)
    texts = [sentence(rng, rng.randrange(1, 120)) for _ in range(60)]
    texts += [texts[0], texts[1] + " end", texts[2].upper(), "", None, " \t\n", "###", "short text", "É é Ça va"]
    passage = sentence(rng, 60)
    near = passage.split()
    near[30] = "changed"
    texts += [sentence(rng, 20) + "\n" + passage, passage + "\n" + sentence(rng, 9), " ".join(near), passage.title()]
    texts += ["same eight words are said here again now. " * 30, " ".join(["x"] * 20_000), "9" * 3000, "a@" * 500]
    texts += [
        "mail me: a.b@c.org, d@e f@g..h x@y.z_w@v.u", "1.2.3.4.5.6.7.8 999.1.1.1 0255.1.1.1", "4111 1111-1111 1111 and 4111111111111112",
        "+1 (377) 555-0271 or +12 or +1234567890123456", "É+49 30 1234567", "card 4111111111111111.",
    ]
    rows = [(i, t, "en", f"src{i % 5}", 0, "x", "h", 1) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[5], None, None, None, None, None, None), (None, "no id", None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def counted(frame, *columns):
    return sorted(map(repr, (tuple(r) for r in frame.select(*columns).collect())))


def test_components_of_a_long_chain_a_star_and_a_loop(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, i) for i in range(1001, 1400)]
    links = spark.createDataFrame(chain[::-1] + star + [(2000, 2000), (3, 2), (None, 5)], "a long, b long")
    for every_step in (False, True):
        found = {r.node: r.component for r in components(links, every_step).collect()}
        assert len(found) == 301 + 400
    assert found == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1400)}
    assert components(links.limit(0)).collect() == []


def brute_print(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(A_TO_Z)) if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, far=4):
    group = {p: p for p in prints}
    for a, b in itertools.combinations(sorted(group), 2):
        if (a ^ b).bit_count() <= far:
            old, new = group[a], group[b]
            group = {p: new if g == old else g for p, g in group.items()}
    return group


def test_simhash_components(docs, rows):
    prints = [brute_print(r[1]) for r in rows]
    group = brute_groups(set(prints))
    least = {}
    for r, p in zip(rows, prints):
        if r[0] is not None:
            least[group[p]] = min(least.get(group[p], r[0]), r[0])
    want = sorted(repr((r[0], f"{p:016x}", least.get(group[p], r[0]))) for r, p in zip(rows, prints))
    found = simhash.simhash_components(docs)
    assert counted(found, "doc_id", simhash.fingerprint_hex(F.col("print")), "component_id") == want


@pytest.mark.parametrize("segments, hot", [(2, 500), (3, 500), (3, 3), (4, 500), (5, 500)])
def test_close_fingerprints_are_linked_also_in_crowded_buckets(spark, monkeypatch, segments, hot):
    monkeypatch.setattr(simhash, "HOT_BUCKET", hot)
    rng = random.Random(segments + hot)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for p in prints[:25]:
        for _ in range(3):
            q = p
            for b in rng.sample(range(64), rng.randrange(1, 7)):
                q ^= 1 << b
            prints.append(q)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in set(prints)]
    found = simhash.links(spark.createDataFrame(signed, "print long"), segments=segments).collect()
    pairs = [(a % (1 << 64), b % (1 << 64)) for a, b in found]
    assert all((a ^ b).bit_count() <= 4 for a, b in pairs)
    group = {p: p for p in prints}
    for a, b in pairs:
        old, new = group[a], group[b]
        group = {p: new if g == old else g for p, g in group.items()}
    want = brute_groups(set(prints))
    split = lambda g: sorted(sorted(p for p in g if g[p] == v) for v in set(g.values()))
    assert split(group) == split(want)


def test_one_document_of_each_group_stays(docs, rows):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    found = simhash.simhash_components(docs).collect()
    first = {r.component_id for r in found if r.doc_id is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(first)
    assert ids.count(None) == 1  # the one whose group has no id; the copy of document 5 is gone


def windows(text):
    words = re.findall(WORD, (text or "").translate(A_TO_Z))
    return words, [tuple(words[i : i + 10]) for i in range(len(words) - 9)] if len(words) >= 10 else ([tuple(words)] if words else [])


def test_contamination(spark, docs, rows):
    items = [(1, rows[0][1], "l"), (2, " ".join((rows[6][1] or "").split()[:14]), "l"), (3, "Short Text", "l"), (4, None, "l"), (5, "", "l"),
             (None, rows[7][1], "l"), (7, " ".join(["x"] * 10), "l"), (1, rows[0][1], "l"), (8, "é", "l")]
    want = []
    for r in rows:
        words, _ = windows(r[1])
        hit, met = set(), set()
        for item, text, _ in items:
            for w in windows(text)[1]:
                for i in range(len(words) - len(w) + 1):
                    if words[i] == w[0] and tuple(words[i : i + len(w)]) == w:
                        hit.update(range(i, i + len(w)))
                        met.add(item)
        names = sorted(str(i) for i in met if i is not None)
        sha = hashlib.sha256(",".join(names).encode()).hexdigest()
        want.append(repr((r[0], len(words), len(hit), len(names), sha, bool(hit))))
    bench = spark.createDataFrame(items, ITEMS)
    found = decontaminate.contamination(docs, bench)
    assert counted(found, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(want)
    clean = sum(w.endswith("False)") for w in want)
    assert decontaminate.drop_contaminated(docs, bench).count() == clean
    assert decontaminate.contamination(docs, bench.limit(0)).filter("contaminated").count() == 0


FORMATS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def is_valid(kind, found):
    digits = [int(c) for c in re.sub("[^0-9]", "", found)]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        luhn = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1]))
        return 13 <= len(digits) <= 19 and luhn % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def exact(text):
    return [(k, m.start(), m.end()) for k, p in FORMATS.items() for m in re.finditer(p, text or "") if is_valid(k, m[0])]


def test_exact_personal_data(docs, rows):
    want = []
    for r in rows:
        found = exact(r[1])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        n = [sum(k == kind for k, _, _ in found) for kind in FORMATS]
        want.append(repr((r[0], *n, hashlib.sha256(listed.encode()).hexdigest(), listed)))
    found = pii.personal_data(docs)  # too few candidates here: nothing is added
    assert counted(found, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans") == sorted(want)


def test_trees_add_looser_forms_and_redaction_covers_both(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        number = f"({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"
        text = f"{sentence(rng, 5)} call +1 {number} today " if i % 2 else f"{sentence(rng, 5)} part {rng.randrange(10**6, 10**9)} sold "
        rows.append((i, text + sentence(rng, 3), len(text)))
    rows.append((400, "please call (377) 555-0271 today or +1 (377) 555-0272 now", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").repartition(4)
    last = pii.personal_data(docs).filter("doc_id = 400").first()
    assert (last.n_phone, last.spans) == (1, "phone:12:26,phone:36:53")
    plain = pii.redacted(docs).filter("doc_id = 400").first()
    assert plain.text == "please call [PHONE] today or [PHONE] now" and plain.n_chars == len(plain.text)


def test_spans_that_touch_exact_ones(spark):
    rng = random.Random(12)
    rows = []
    for i in range(40):
        exact = sorted((a, a + rng.randrange(1, 9)) for a in (rng.randrange(400) for _ in range(rng.randrange(8))))
        cuts = sorted(rng.sample(range(400), 2 * rng.randrange(1, 160)))
        rows.append((i, exact, list(zip(cuts[::2], cuts[1::2]))))
    kind = "array<struct<start:bigint,end:bigint>>"
    found = spark.createDataFrame(rows, f"id int, exact {kind}, spans {kind}").select("id", pii.touches(F.col("exact"), F.col("spans")).alias("t"))
    for r in found.collect():
        _, exact, spans = rows[r.id]
        assert r.t == [any(a < d and c < b for c, d in exact) for a, b in spans]


def test_judged_examples_that_were_held_back(spark, nothing):
    """Made-up data in disturbed formats is found, look-alikes are not; without any document the trees are the same kind."""
    judge = pii.fit(nothing)
    least = F.get(F.array(*[F.lit(t) for t in judge.thresholds]), F.col("kind"))
    taken = (judge.probability(F.col) >= least).cast("int").alias("taken")
    held = pii.made_up_examples(spark).filter("fold = 0").select("kind", "label", taken)
    for r in held.groupBy("kind").agg(
        F.avg(F.when(F.col("label") == 1, F.col("taken"))).alias("recall"), F.avg(F.when(F.col("label") == 0, 1 - F.col("taken"))).alias("spared")
    ).collect():
        assert r.recall > 0.9 and r.spared > 0.9, r


def test_trees_are_fitted_on_every_document(spark, monkeypatch):
    docs = spark.range(22_000).select(F.concat(F.lit("part "), (F.col("id") + 10_000_000).cast("string")).alias("text"))
    read = []
    fitted = pii._thresholds
    monkeypatch.setattr(pii, "_thresholds", lambda rows, judge: read.append(rows.count()) or fitted(rows, judge))
    candidates = pii.training_candidates(docs)
    assert candidates.filter("label = 0").count() == 22_000
    assert len(pii.fit(docs).thresholds) == len(pii.ALL_KINDS)
    held = candidates.filter("fold = 0").count() + pii.made_up_examples(spark, 2_200).filter("fold = 0").count()
    assert read == [held]


def test_secrets_and_disturbed_formats_are_added(spark):
    rng = random.Random(6)
    key = hashlib.sha1(b"x").hexdigest()
    texts = [
        f'{sentence(rng, 9)} token = "{key}" {sentence(rng, 4)}', "write to anna.lee (at) web7 (dot) org today", "plain words 2024-01-02 and more",
        "host 10[.]2[.]3[.]4 is down, 10.2.3.4 is up", f"{sentence(rng, 60)}", "paid by visa: 4111.1111.1111.1111 yesterday",
    ]
    table = spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(texts)], "doc_id int, text string, `row` int, exact string")
    found = {r.doc_id: r for r in pii.personal_data(table).collect()}
    assert found[0].n_secret == 1 and found[0].spans == f"secret:{texts[0].index(key)}:{texts[0].index(key) + 40}"
    assert [found[i].n_added for i in range(6)] == [1, 1, 0, 1, 0, 1]
    assert found[3].n_ip == 1 and len(found[3].spans.split(",")) == 2
    plain = {r.doc_id: r for r in pii.redacted(table).collect()}
    assert [r for r in plain[0].asDict()] == ["doc_id", "text", "row", "exact"] and plain[0].row == 7
    assert key not in plain[0].text and "[SECRET]" in plain[0].text and plain[4].text == texts[4]
    assert plain[3].text == "host [IP] is down, [IP] is up" and plain[1].text == "write to [EMAIL] today"


def test_plans_do_not_grow_with_kinds_and_tree_nodes(spark, nothing, monkeypatch):
    """Each step is one expression for all kinds, and the trees are a constant: the driver builds little."""
    judge = pii.fit(nothing)
    built = Counter()

    def counting(owner, name):
        made = getattr(owner, name)
        monkeypatch.setattr(owner, name, lambda *a, **b: built.update([name]) or made(*a, **b))

    for owner, name in ((pii, "_features"), (pii, "touches"), (F, "when")):
        counting(owner, name)
    pii.with_spans(nothing.select(F.col("doc_id").alias("row"), "text"), judge)
    assert built["_features"] == built["touches"] == 1 and built["when"] < 60
    built.clear()
    pii.training_candidates(nothing)
    assert built["_features"] == 1 and built["touches"] == 2
    built.clear()
    pii.made_up_examples(spark)
    assert built["_features"] == 1


def test_trees_as_a_constant_judge_as_their_nodes_do(spark):
    """Two trees of unlike depth, walked by hand."""
    judge = pii.Judge([], [])
    judge.trees = [
        [(5, 20.0, 1, 2, 0.0), (0, 0.0, 1, 1, -1.0), (6, 7.5, 3, 4, 0.0), (0, 0.0, 3, 3, 0.25), (0, 0.0, 4, 4, 1e-07)],
        [(0, 0.0, 0, 0, 0.5)],
    ]
    judge.weights = [1.0, 0.1]
    rows = [(20.0, 9.0), (21.0, 7.5), (20.5, 8.0)]
    names = {pii.FEATURES[5]: "a", pii.FEATURES[6]: "b"}
    found = spark.createDataFrame(rows, "a double, b double").select(judge.probability(lambda n: F.col(names[n]) if n in names else F.lit(0.0)).alias("p"))
    for r, leaf in zip(found.collect(), (-1.0, 0.25, 1e-07)):
        assert abs(r.p - 1 / (1 + math.exp(-2 * (leaf + 0.1 * 0.5)))) < 1e-12


def test_long_texts_are_rewritten_in_proportion(spark):
    rng = random.Random(1)
    words = [f"u{i}@h{i % 97}.example.com" if rng.random() < 0.7 else "É word" for i in range(3000)]
    table = spark.createDataFrame([(1, " ".join(words)), (2, None), (3, "")], "doc_id int, text string")
    start = time.monotonic()
    plain = {r.doc_id: r.text for r in pii.redacted(table).collect()}
    assert plain[1] == " ".join("[EMAIL]" if "@" in w else w for w in words) and plain[2] is None and plain[3] == ""
    assert time.monotonic() - start < 180


def test_host_counts_and_verdicts(spark, docs, rows):
    found = {}
    for r in host_rules.quality_by_host(docs).collect():
        found.setdefault(r.doc_id, r)
    for r in rows:
        text = r[1] or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        spots = {}
        for i in range(len(words) - 7):
            spots.setdefault(tuple(words[i : i + 8]), []).append(i)
        again = len({p for at in spots.values() if len(at) > 1 for i in at for p in range(i, i + 8)})
        if r[0] is None:
            continue
        got = found[r[0]]
        assert (got.n_words, got.word_chars, got.n_symbols) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)))
        assert (got.n_dup_lines, got.n_repeat_words) == (len(lines) - len(set(lines)), again)
        assert got.base_failed == (len(words) < 20 or 100 * again > 30 * len(words))
    rng = random.Random(1)
    bad = [(i, "## " * 30 + sentence(rng, 9), "en", "bad", 0, "", "", 0) for i in range(40)]
    good = [(100 + i, sentence(rng, 30), "en", f"good{i % 3}", 0, "", "", 0) for i in range(90)]
    both = spark.createDataFrame(bad + good + [(7000, sentence(rng, 30), "en", "bad", 0, "", "", 0)], DOCS)
    assert {r.doc_id for r in host_rules.keep_good(both).collect()} == {r[0] for r in good}


def brute_shares(children, budget, cap):
    """children: name → weight; fill what is full first, share the rest by weight."""
    given, left, live = {}, budget, dict(children)
    while live:
        total = sum(live.values())
        full = [c for c in live if live[c] > 0 and cap[c] * total <= left * live[c]]
        if not full:
            for c, w in live.items():
                given[c] = min(cap[c], left * w // total) if w else 0
            return given
        first = min(full, key=lambda c: (cap[c] / live[c], c))
        given[first] = cap[first]
        left -= cap[first]
        del live[first]
    return given


def test_mixture_budgets_and_prefixes(docs, rows):
    plan = mixing.mixture(docs, levels(), weights(), budget_percent=150).collect()
    leaf, size = {}, {}
    known = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, {"en": 5, "de": 2, "fr": 2, "es": 1}
    for r in plan:
        key = (r.domain, r.lang, r.source)
        leaf.setdefault(key, []).append(r)
        size[key] = size.get(key, 0) + r.tokens
    cap = {}
    for key, n in size.items():
        for depth in (1, 2, 3):
            cap[key[:depth]] = cap.get(key[:depth], 0) + 4 * n
    def share(path, budget):
        kids = sorted({k[: len(path) + 1] for k in size if k[: len(path)] == path})
        weight = {k: known[len(path)].get(k[-1], 1) if len(path) < 2 else 1 for k in kids}
        out = {}
        for kid, given in brute_shares(weight, budget, cap).items():
            out |= {kid: given} if len(kid) == 3 else share(kid, given)
        return out
    want = share((), sum(size.values()) * 150 // 100)
    for key, members in leaf.items():
        assert {m.budget for m in members} == {want[key]}
        if not size[key]:
            assert all(m.copies == 0 for m in members)
            continue
        epochs, rest = divmod(want[key], size[key])
        order = lambda m: (hashlib.md5(f"0:{epochs}:{'' if m.doc_id is None else m.doc_id}".encode()).hexdigest(), m.text_hash)
        upto = 0
        for _, tied in itertools.groupby(sorted(members, key=order), key=order):
            tied = list(tied)
            upto += sum(m.tokens for m in tied)
            assert all(m.copies == (epochs + (upto <= rest) if m.tokens else 0) for m in tied)
    taken = mixing.take(docs, mixing.mixture(docs, levels(), weights(), budget_percent=150))
    assert taken.count() == sum(r.copies for r in plan)
    assert taken.columns == [*docs.columns, "epoch"]


def test_small_ranges_give_the_same_prefix(docs, monkeypatch):
    before = counted(mixing.mixture(docs, levels(), weights()), "doc_id", "text_hash", "copies")
    monkeypatch.setattr(mixing, "RANGE_ROWS", 1)
    assert counted(mixing.mixture(docs, levels(), weights()), "doc_id", "text_hash", "copies") == before


def test_license_phrases_and_notices(docs):
    text = "All Rights Reserved. CC-BY cc by xcc by all rights reserved; GNU general, public license"
    words = re.findall(WORD, text.translate(A_TO_Z))
    places = sorted(i for p in license_scan.PHRASES for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
    n_words, n_base, first, last, base, *_ = license_scan.scan(text)
    assert (n_words, n_base, first, last, base) == (len(words), len(places), places[0], places[-1], "cc-by,gpl,reserved")
    for notice, label, *_ in license_scan.NOTICES:
        edits = license_scan._edits(notice)
        rng = random.Random(len(notice))
        worn = list(notice)
        for i in rng.sample([i for i, c in enumerate(notice) if c != " "], edits):
            worn[i] = "q"
        found = license_scan.scan("before it " + "".join(worn) + " after it")
        assert label in found[5].split(",") and found[7][0]["first_word"] == 2
    assert license_scan.scan(None) == (0, 0, None, None, "", "", 0.0, [])
    assert license_scan.license_notices(docs).count() == docs.count()


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script><style>p{}</style></head><body>
<nav><ul><li><a href=/a>Home</a><li><a href=/b>More</a></ul></nav><!-- <p>gone</p> --><div class="top ad">Buy now</div>
<div id=content><h1>Caf&eacute; &amp; bar</h1><p>The man in the street went to the house of the king and it was good.<br>Next
 line</p><p>Short.</p><p><a href=x>one</a> <a href=y>two</a></p></div>
<aside>Side</aside><section class="comments"><p>I am of the opinion that it is the best of all the things we have.</p></section>
<form><p>Name</p></form><footer>&copy; me</footer></body></html>"""


def test_main_text(spark):
    whole = "Café & bar\n\nThe man in the street went to the house of the king and it was good. Next line\n\nShort."
    assert html_text.main_text(PAGE) == whole
    assert html_text.main_text(PAGE.replace("<div id=content>", "<article>").replace("two</a></p></div>", "two</a></p></article>")) == whole
    assert html_text.main_text("<p>cut &amp; <b>off <a hre") == "cut & off"
    assert [html_text.main_text(x) for x in (None, "", "<script>", "<!-- ", "plain")] == ["", "", "", "", "plain"]
    pages = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (2, None, None)], "page_id long, url string, html string")
    assert counted(html_text.extract_main_text(pages), "page_id", "n_chars") == sorted([repr((1, len(whole))), "(2, 0)", "(2, 0)"])


def labels_by_hand(labels):
    """Every undecided block asks all decided ones."""
    out = []
    for i, label in enumerate(labels):
        decided = [(abs(i - j), not other) for j, other in enumerate(labels) if other is not None]
        out.append(label if label is not None else not min(decided)[1] if decided else True)
    return out


def test_blocks_inherit_from_the_nearest_decided(spark):
    rng = random.Random(2)
    for _ in range(400):
        labels = [rng.choice([True, False, None, None]) for _ in range(rng.randrange(12))]
        assert html_text.inherited(labels) == labels_by_hand(labels)
    prose = "The man in the street went to the house of the king and it was good for him and for all of them in the end."
    assert len(html_text._words(prose)) >= html_text.LONG_WORDS
    advert = " ".join(f"buy{i} cheap{i}" for i in range(30))
    page = f"<div>{prose}</div><div>short one</div><p>{advert}</p><p>tiny</p><p>{advert}</p>"
    assert html_text.main_text(page) == f"{prose}\n\nshort one"
    # no function words on the whole page: another language, where they tell nothing
    assert html_text.main_text(f"<p>{advert}</p><p>tiny</p>") == f"{advert}\n\ntiny"
    # in the article element they are the article
    assert html_text.main_text(f"<p>{prose}</p><article><p>{prose}</p><p>{advert}</p></article>") == f"{prose}\n\n{advert}"
    assert html_text.main_text(f"<article>see</article><p>{prose * 6}</p>".replace(".", ". ")).startswith("see\n\nThe man")


def test_a_link_left_open_ends_with_its_element():
    prose = "The man in the street went to the house of the king and it was good for him and for all of them in the end."
    assert html_text.main_text(f"<div><p><a href=x>menu</p></div><p>{prose}</p>") == prose
    assert html_text.main_text(f"<p><a href=x>{prose}</a></p>") == ""


def test_deep_and_broken_pages_take_time_in_proportion():
    start = time.monotonic()
    html_text.main_text("<div>" * 60_000 + "x" + "</p>" * 60_000)
    html_text.main_text("<p>" * 60_000 + "</section>" * 60_000)
    html_text.main_text("<a href=x>" * 60_000 + "<br>" * 60_000)
    assert time.monotonic() - start < 20


def labelled(spark, good, bad, n=400):
    rng = random.Random(9)
    rows = [(i, (bad if i % 3 == 0 else good)(rng), "en", "s", 0, "", "", 0) for i in range(n)]
    labels = [(i, 0 if i % 3 == 0 else 1, 1 if i % 3 == 0 else 0) for i in range(n)]
    return spark.createDataFrame(rows, DOCS).repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_on_held_out_documents(spark, docs, nothing):
    table, labels = labelled(spark, lambda r: sentence(r, 30), lambda r: sentence(r, 30).replace(" ", "## "))
    scored = quality_model.quality_scores(table, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    assert np.mean([(r.predicted == 1) == (r.doc_id % 3 != 0) for r in scored if r.held_out]) > 0.98
    odd = quality_model.quality_scores(docs, labels)
    assert odd.count() == docs.count() and odd.filter("score is null or score < 0 or score > 1").count() == 0
    assert {r.score for r in quality_model.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_model.quality_scores(nothing, labels).collect() == []


def cosines_by_hand(texts, query):
    """Cosines of all TF-IDF vectors, over all words, by plain loops."""
    counts = [Counter(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t.translate(A_TO_Z))) for t in texts]
    met = Counter(w for c in counts for w in c)

    def vector(c):
        v = {w: (1 + math.log(n)) * math.log((len(texts) + 1) / met[w]) ** toxicity.IDF_POWER for w, n in c.items() if w in met}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {w: x / norm for w, x in v.items()}

    known = [vector(c) for c in counts]
    asked = vector(Counter(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", query.translate(A_TO_Z))))
    return np.array([sum(x * v.get(w, 0.0) for w, x in asked.items()) for v in known])


def test_nearest_examples_are_those_of_a_full_comparison(monkeypatch):
    """Words of every rarity count, in blocks of any size, read or left out."""
    rng = random.Random(3)
    texts = [" ".join([sentence(rng, 25), "the and", rng.choice(["de", "es"]), f"once{i}"]) for i in range(240)]
    texts += texts[:6] + ["", "the"]
    labels = np.array([i % 3 == 0 for i in range(len(texts))])
    for block in (16, 256):
        monkeypatch.setattr(toxicity, "BLOCK", block)
        index = toxicity.build(np.arange(len(texts)), [toxicity.word_counts(t) for t in texts], labels, k=7)
        assert 0 < index.full.shape[1] < len(index.terms)
        index.read = [0, 0]
        for t in texts[:30] + ["", "alpha1 beta2", "once5 once7", "the the and", "unknown", sentence(rng, 400)]:
            cosines = cosines_by_hand(texts, t)
            ((yes, no),) = index.nearest([index.vector(*toxicity.word_counts(t))])
            for kind, (found, got) in ((True, yes), (False, no)):
                own = cosines[labels == kind]
                assert np.allclose(got, np.sort(own[own > 1e-9])[::-1][:7], atol=1e-5)
                assert np.allclose(cosines[index.ids[found].astype(int)], got, atol=1e-5)
                assert (labels[index.ids[found].astype(int)] == kind).all()
        assert index.read[0] < index.read[1] or block == 256


def test_toxic_words_are_learned(spark, docs, nothing):
    table, labels = labelled(spark, lambda r: sentence(r, 30), lambda r: sentence(r, 25) + " vile foul rude " + sentence(r, 5))
    # a word that every third text has says little by its idf: the marked words are rarer
    rare = table.filter("doc_id % 3 <> 0 or doc_id < 60")
    scored = toxicity.toxicity_scores(rare, labels.join(rare.select("doc_id"), "doc_id")).collect()
    assert np.mean([(r.predicted == 1) == (r.doc_id % 3 == 0) for r in scored if r.held_out]) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in scored)
    toxic = {r.doc_id for r in labels.filter("toxic = 1").collect()}
    assert all(set(r.evidence) <= toxic and len(r.evidence) == toxicity.EVIDENCE for r in scored if r.doc_id % 3 == 0)
    odd = toxicity.toxicity_scores(docs, labels)
    assert odd.count() == docs.count() and odd.filter("score is null or score < 0 or score > 1").count() == 0
    assert {r.score for r in toxicity.toxicity_scores(docs, labels.limit(0)).collect()} == {0.5}
    for kind in (0, 1):
        assert {r.score for r in toxicity.toxicity_scores(docs, labels.filter(f"toxic = {kind}")).collect()} == {float(kind)}
    assert toxicity.toxicity_scores(nothing, labels).collect() == []


def test_few_telling_words_among_many_that_say_nothing():
    """A text is judged by words that go with the label, also where hundreds of rarer ones are in it."""
    rng = random.Random(8)

    def text(toxic):
        words = [f"w{int(rng.paretovariate(0.25)) % 20_000}" for _ in range(300)]
        return " ".join([*words, *(rng.sample(["vile", "foul", "rude", "mean", "crude"], 2) if toxic else [])])

    labels = np.arange(400) % 2 == 0
    index = toxicity.build(np.arange(400), [toxicity.word_counts(text(y)) for y in labels], labels, k=50, by_label=True)
    scores, _ = index.judge([text(i % 2 == 0) for i in range(200)])
    assert (scores[::2] >= toxicity.THRESHOLD).mean() > 0.95 and (scores[1::2] < toxicity.THRESHOLD).mean() > 0.85
    met, met_toxic = np.array([10, 10, 20]), np.array([10, 5, 20])
    ratio = toxicity.evidence_of_words(met, met_toxic, 20, 40)
    assert np.allclose(ratio[[0, 1, 2]], [2 * (10 * math.log(2) + 10 * math.log(10 / 15) + 20 * math.log(20 / 15)), 0, 80 * math.log(2)])


def test_text_ids_and_a_bounded_sample(spark):
    table, labels = labelled(spark, lambda r: sentence(r, 30), lambda r: sentence(r, 25) + " vile foul rude")
    named = [t.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string"))) for t in (table, labels)]
    scored = toxicity.toxicity_scores(*named).collect()
    assert all(e.startswith("d") for r in scored for e in r.evidence) and any(r.evidence for r in scored)
    again = named[0].unionByName(named[0]).unionByName(named[0].withColumn("text", F.lit("zz")))
    assert toxicity.train(again, named[1], bound=10**9).ids.tolist() != []
    assert len(toxicity.train(again, named[1], bound=10**9).ids) == len(toxicity.train(*named, bound=10**9).ids)
    few = toxicity.sampled_examples(named[1], "toxic", 60).groupBy("label").count().collect()
    assert {r["label"] for r in few} == {0, 1} and all(10 <= r["count"] <= 60 for r in few)


def passages_by_hand(rows, similarity):
    """Paragraphs as (doc_id, place) → (start, end, n_words, first of its cluster), for those that are repeated."""
    lines = []
    for i, t in {(r[0], r[1]) for r in rows if r[0] is not None}:
        at = 0
        for place, line in enumerate((t or "").split("\n")):
            words = line.translate(A_TO_Z).split()
            if len(words) >= 5:
                lines.append(((i, place), at, at + len(line), frozenset(tuple(words[j : j + 5]) for j in range(len(words) - 4)), tuple(words)))
            at += len(line) + 1
    parent = {x[0]: x[0] for x in lines}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(lines, 2):
        if a[4] == b[4] or len(a[3] & b[3]) / len(a[3] | b[3]) >= similarity:
            low, high = sorted((root(a[0]), root(b[0])))
            parent[high] = low
    group = {k: root(k) for k in parent}
    many = {g for g, n in Counter(group.values()).items() if n > 1}
    return {k: (start, end, len(words), group[k]) for k, start, end, _, words in lines if group[k] in many}


@pytest.mark.parametrize("similarity", [0.8, 0.5])
def test_repeated_passages(docs, rows, similarity):
    """All columns of both results."""
    want = passages_by_hand(rows, similarity)
    found = paragraph_dedup.repeated_paragraphs(docs, similarity=similarity)
    expected = sorted(repr((*k, a, b, n, first[0], k != first)) for k, (a, b, n, first) in want.items())
    assert counted(found, "doc_id", "place", "start", "end", "n_words", "first_doc", "removed") == expected
    assert len(want) >= 8
    reports = {}
    for i in {r[0] for r in rows}:
        own = sorted((a, b, n, first[0], k != first) for k, (a, b, n, first) in want.items() if k[0] == i)
        reports[i] = (
            i, len(own), sum(x[4] for x in own), sum(x[2] for x in own), max([x[2] for x in own], default=0),
            min([x[3] for x in own] + [i]) if i is not None else None, ",".join(f"{a}:{b}:{f}" for a, b, _, f, _ in own),
        )
    each = paragraph_dedup.passage_dedup(docs, similarity=similarity)
    assert {r.doc_id: tuple(r) for r in each.collect()} == reports


def runs_by_hand(rows, size):
    """Components of documents with ``size`` words in a row in common."""
    group = {r[0]: r[0] for r in rows if r[0] is not None}
    windows = {}
    for doc, text, *_ in rows:
        words = (text or "").translate(A_TO_Z).encode().split()
        for i in range(len(words) - size + 1 if doc is not None else 0):
            other = group[windows.setdefault(tuple(words[i : i + size]), doc)]
            low, high = sorted((other, group[doc]))
            group = {d: low if g == high else g for d, g in group.items()}
    return group


@pytest.mark.parametrize("size", [1, 7, 51])
def test_documents_that_share_words_in_a_row(spark, size):
    rng = random.Random(size)
    pool = [sentence(rng, n) for n in (size, size + 1, size + 40, 3 * size, max(1, size - 1), 200)]
    cuts = [sentence(rng, size // 2) + " " + " ".join(rng.choice(pool).split()[rng.randrange(3) :]) + " " + sentence(rng, size // 2) for _ in range(60)]
    texts = [re.sub(" ", lambda m: rng.choice([" ", " ", "\n", "\t", "\r\n"]), t) for t in cuts] + ["", None, "a " * 300, "A\n" * 301, cuts[0] * 2]
    rows = [(f"d{i:03}", t) for i, t in enumerate(texts)] + [("d001", pool[0]), (None, pool[1])]
    table = spark.createDataFrame(rows, "doc_id string, text string").repartition(7)
    found = {r.node: r.component for r in components(shared_runs.run_links(table, size)).collect()}
    want = runs_by_hand(rows, size)
    assert {d: found.get(d, d) for d in want} == want
    assert len(set(want.values())) < len(want)
    assert shared_runs.run_links(table.limit(0), size).collect() == []


def test_passages_are_written_only_where_documents_are_still_apart(spark, monkeypatch):
    """Documents with a long passage in common are joined by its middle; the ends of it need not be looked at again."""
    rng = random.Random(8)
    long, other = sentence(rng, 200), sentence(rng, 55)
    rows = [(i, f"{sentence(rng, 20)} {long} {sentence(rng, 20)}") for i in range(12)]
    written = []

    def counting(docs, wanted, size, real=shared_runs.passages_of):
        written.append(wanted.count())
        return real(docs, wanted, size)

    monkeypatch.setattr(shared_runs, "passages_of", counting)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.node, r.component) for r in components(shared_runs.run_links(table, 51)).collect()} == {(i, 0) for i in range(12)}
    rows += [(20 + i, f"{sentence(rng, 20)} {other} {sentence(rng, 20)}") for i in range(4)] + [(30, f"{sentence(rng, 3)} {other} {long[:50]}")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    want = runs_by_hand(rows, 51)
    found = {r.node: r.component for r in components(shared_runs.run_links(table, 51)).collect()}
    assert {d: found.get(d, d) for d in want} == want and len(set(want.values())) == 2
    assert written[0] == 0 and written[1] <= 5


def test_rare_shingles_are_those_that_others_share(spark):
    rng = random.Random(4)
    lines = family(rng, 20) + [sentence(rng, 15) for _ in range(30)]
    table = spark.createDataFrame(list(enumerate(lines)), "id long, words string")
    rare = {}
    for r in paragraph_dedup.rare_shingles(table, 0.8).collect():
        rare.setdefault(r.id, set()).add(r.shingle)
    held = Counter(s for own in rare.values() for s in own)
    every = {}
    for i, line in enumerate(lines):
        every[i] = set(paragraph_dedup.shingle_hashes([line.encode()])[0].view("int64").tolist())
    share = Counter(s for own in every.values() for s in own)
    assert held and all(share[s] > 1 for s in held) and not set(rare) & set(range(40, 70))
    assert all(rare[i] <= every[i] for i in rare)
    pairs = [(i, j) for i, j in itertools.combinations(range(70), 2) if paragraph_dedup.jaccard(lines[i], lines[j]) >= 0.8]
    assert len(pairs) >= 20 and all(rare[i] & rare[j] for i, j in pairs)


@pytest.mark.parametrize("most_bits", [1 << 15, 1 << 28])
def test_keys_find_their_rows_without_moving_the_others(spark, monkeypatch, most_bits):
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(lookups, "MOST_BITS", most_bits)
    table = spark.createDataFrame([(f"k{i % 9000}" if i % 9000 else None, i) for i in range(18000)], "key string, row long")
    keys = spark.createDataFrame([(f"k{i}", -i) for i in range(3, 9000, 3)] + [("other", 1)], "key string, value long")
    found = lookups.found_by(table, keys, "key")
    assert sorted((r.key, r.row, r.value) for r in found.collect()) == sorted((f"k{i % 9000}", i, -(i % 9000)) for i in range(18000) if i % 9000 and i % 3 == 0)
    passed = lookups.likely(table, keys, "key", 3000)
    assert passed.columns == table.columns and 5998 <= passed.count() < (7500 if most_bits > 1 << 15 else 9000)


def test_passages_with_every_join_shuffled(spark, monkeypatch):
    for module in (lookups, shared_runs):
        monkeypatch.setattr(module, "BROADCAST_ROWS", 0)
    rng = random.Random(3)
    pool = [sentence(rng, n) for n in (6, 12, 60, 90)]
    rows = [(f"d{i:02}", "\n".join([sentence(rng, 7), rng.choice(pool), sentence(rng, 20)])) for i in range(25)]
    rows += [("d25", family(rng, 2)[0]), ("d26", None), rows[0], ("d01", pool[0])]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    want = passages_by_hand(rows, 0.8)
    found = paragraph_dedup.repeated_paragraphs(docs)
    assert counted(found, "doc_id", "place", "start", "first_doc") == sorted(repr((*k, a, f[0])) for k, (a, _, _, f) in want.items())
    each = {r.doc_id: r.component_id for r in paragraph_dedup.passage_dedup(docs, passage_words=51).collect()}
    assert each == runs_by_hand(rows, 51)


def test_long_passages_join_documents_whatever_their_lines(spark):
    """Short repeated lines join nothing, long passages do where lines break elsewhere, and components are transitive."""
    rng = random.Random(12)
    short, long = sentence(rng, 12), sentence(rng, 60).split()
    near = list(long)
    near[30] = "changed"
    joined = [
        " ".join(long), "\n".join(" ".join(long[i : i + 13]) for i in range(0, 60, 13)), " ".join(near),
        f"{sentence(rng, 20)} {' '.join(long[:51])} {sentence(rng, 20)}", f"{' '.join(long[9:])}\n{sentence(rng, 70)}",
    ]
    alone = [sentence(rng, 30) + "\n" + short, sentence(rng, 9) + " " + " ".join(long[:50]) + " " + sentence(rng, 9), " ".join(sentence(rng, 60) for _ in range(2))]
    alone += [alone[2][:200] + "\n" + short, f"{short}\n" * 9]
    last = joined[4].split("\n")[1]
    rows = list(enumerate(alone[:2] + joined + alone[2:] + [last]))
    found = {r.doc_id: r for r in paragraph_dedup.passage_dedup(spark.createDataFrame(rows, "doc_id long, text string"), passage_words=51).collect()}
    assert [found[i].component_id for i in range(11)] == [0, 1, 2, 2, 2, 2, 2, 7, 8, 9, 2]
    assert found[0].n_repeated == 1 and found[9].n_repeated == 9


def family(rng, size):
    """Paragraphs on one template: each is like some others, few are like the first."""
    common = sentence(rng, 30).split()
    rows = []
    for i in range(size):
        words = common + sentence(rng, 12).split()
        words[i % 30] = f"x{i % 5}"
        rows.append(words)
        near = list(words)
        near[-1] = "other"
        rows.append(near)
    return [" ".join(w) for w in rows]


@pytest.mark.parametrize("block", [3, 1024])
def test_a_crowded_bucket_loses_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(paragraph_dedup, "BLOCK", block)
    rng = random.Random(block)
    lines = family(rng, 25) + [sentence(rng, 8)] * 40 + [sentence(rng, 4)] * 3
    rows = [(i, "\n".join(lines[i : i + 1] + ["tail"])) for i in range(len(lines))]
    rng.shuffle(rows)
    table = spark.createDataFrame([(str(i), t, "x") for i, t in rows], "doc_id string, text string, digest string")
    want = passages_by_hand([(str(i), t) for i, t in rows], 0.8)
    found = paragraph_dedup.repeated_paragraphs(table)
    assert counted(found, "doc_id", "place", "first_doc") == sorted(repr((*k, first[0])) for k, (*_, first) in want.items())
    # every paragraph in the same bucket: what the bands do not tell apart, the rare shingles must
    stored = paragraph_dedup.cut(paragraph_dedup.paragraphs(table))
    same = stored.withColumn("bands", F.when(F.col("words").isNotNull(), F.array(F.lit(7).cast("long"))))
    clusters = {bytes(r.digest): bytes(r.cluster) for r in paragraph_dedup.paragraph_clusters(same).collect()}
    of = {(r.doc_id, r.place): bytes(r.digest) for r in stored.collect()}
    grouped = {}
    for k, digest in of.items():
        grouped.setdefault(clusters.get(digest, digest), set()).add(k)
    wanted = {}
    for k, (*_, first) in want.items():
        wanted.setdefault(first, set()).add(k)
    assert {frozenset(g) for g in grouped.values() if len(g) > 1} == {frozenset(g) for g in wanted.values()}


def test_recall_of_the_tuned_bands():
    bands, rows = paragraph_dedup.tuned_bands()
    assert bands * rows <= paragraph_dedup.MOST_HASHES and 1 - (1 - 0.8**rows) ** bands >= 0.999
    rng = random.Random(9)
    pairs, met = 0, 0
    for _ in range(300):
        words = sentence(rng, 60).split()
        other = list(words)
        other[rng.randrange(60)] = "changed"
        a, b = " ".join(words), " ".join(other)
        if paragraph_dedup.jaccard(a, b) >= 0.8:
            signs = paragraph_dedup.signature_bands([a.encode(), b.encode()], bands, rows)
            pairs, met = pairs + 1, met + bool((signs[0] == signs[1]).any())
    assert pairs > 200 and met / pairs > 0.99


def test_documents_with_clashing_columns(spark, rows):
    names = ["_id", "_hash", "copies", "epoch", "row", "copy", "_host", "kept"]
    odd = spark.createDataFrame([(r[0], r[1], r[2], r[3], *range(8)) for r in rows if r[0] is not None][:40], "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` int" for n in names))
    items = spark.createDataFrame([("a", rows[0][1])], "item_id string, text string")
    clean = decontaminate.drop_contaminated(odd, items)
    assert clean.columns == odd.columns and 0 < clean.count() < odd.count()
    mixed = mixing.take(odd, mixing.mixture(odd, levels(), weights()))
    assert set(mixed.columns) == set(odd.columns) and mixed.count() > 0
    assert mixed.select("copy", "row", "_id").distinct().collect() == [(5, 4, 0)]


def test_empty_tables(nothing, spark):
    none = spark.createDataFrame([], ITEMS)
    for found in (
        simhash.simhash_components(nothing), simhash.keep_one(nothing), decontaminate.contamination(nothing, none), pii.personal_data(nothing),
        host_rules.quality_by_host(nothing), host_rules.keep_good(nothing), mixing.mixture(nothing, levels(), weights()),
        license_scan.license_notices(nothing), paragraph_dedup.passage_dedup(nothing),
    ):
        assert found.collect() == []
