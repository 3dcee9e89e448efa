"""Conversation repair, collocations and vector search against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from knockwatch.llm import collocations, quotient_filter as qf, vector_search
from knockwatch.llm import conversation_repair as repair

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- conversations


def all_cheapest(rows, keep=lambda tied: tied):
    """The cheapest edits of (initial, must go, truncated) rows; every equally cheap list is kept to the end, or what
    ``keep`` leaves of those that end alike."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    wanted = {0: "u", 1: "u", 2: "a", 3: "u"}

    def with_inserts(found):
        every = {}
        for origin, lists in found.items():
            for cost, edits in lists:
                state = origin
                for _ in range(4):
                    every.setdefault(state, set()).add((cost, edits))
                    state, cost, edits = after[state, wanted[state]], cost + 2, edits + "I"
        least = {s: min(c for c, _ in lists) for s, lists in every.items()}
        return {s: keep({x for x in lists if x[0] == least[s]}) for s, lists in every.items()}

    found = with_inserts({0: {(0, "")}})
    for initial, must_go, truncated in rows:
        new = {}
        for state, lists in found.items():
            for cost, edits in lists:
                new.setdefault(state, set()).add((cost + 3, edits + "D"))
                if not must_go:
                    if (state, initial) in after:
                        new.setdefault(after[state, initial], set()).add((cost + truncated, edits + "K"))
                    new.setdefault(after[state, wanted[state]], set()).add((cost + 2 + truncated, edits + "R"))
        found = with_inserts(new)
    return min(x for s in (0, 3) for x in found.get(s, ()))


def searched(rows):
    search, edits = repair.Repair(), []
    for row in rows:
        edits += search.add(*row)
    rest, cost = search.finish()
    return cost, "".join(edits + rest)


def test_cheapest_edits_with_ties():
    rng = random.Random(21)
    for n in range(8):
        for _ in range(60):
            rows = [(rng.choice("suax "), rng.random() < 0.15, rng.random() < 0.2) for _ in range(n)]
            assert searched(rows) == all_cheapest(rows), rows


@pytest.mark.parametrize("roles", ["ua", "uua", "x", "sxa", "aau"])
def test_long_conversations_are_settled_as_they_come(roles):
    """What is open stays small, and equals the answer for all turns at once, by whole lists."""
    rows = [(roles[i % len(roles)], i % 17 == 3, i % 5 == 0) for i in range(1500)]
    search, edits, most = repair.Repair(), [], 0
    for i, row in enumerate(rows):
        edits += search.add(*row)
        most = max(most, i + 1 - sum(e != "I" for e in edits))
    rest, cost = search.finish()
    assert (cost, "".join(edits + rest)) == all_cheapest(rows, keep=lambda tied: {min(tied)})
    if roles in ("ua", "uua"):
        assert most < 40


def reports_by_hand(rows):
    """The contract over plain rows (conv_id, turn, role, text)."""
    damaged = []
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        damaged += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in damaged if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, faults = set(), []
        for _, _, role, text in own:
            stripped = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
        cost, audit = all_cheapest([(r[2][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(own, faults)])
        turns = {r[1] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        state, at, lines = None, iter(own), []
        for edit in audit:
            row = next(at) if edit != "I" else None
            if edit == "D":
                continue
            role = "assistant" if state == "u" else "user"
            role, text = (row[2], row[3]) if edit == "K" else (role, row[3] if row else "")
            state = role[:1]
            lines.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def conversation_rows():
    rng = random.Random(5)
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(0, 9)):
            role = rng.choice(["user", "assistant", "assistant", "user", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "Why", "Why? \n", " ", None, f"É {turn}.", "same.", "x" * 5000 + "."])
            rows.append((conv, rng.choice([turn, turn, turn + 3, None]), role, text))
    rows += [rows[5], rows[5], rows[9], (None, 1, "user", "a."), (None, None, None, None), (77, 2**40, "user", "z."), (77, 0, "user", "z.")]
    return rows


def test_reports_equal_plain_loops(spark):
    rows = conversation_rows()
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, digest string, fault int").repartition(5)
    found = {r.conv_id: tuple(r) for r in repair.repair_reports(repair.damaged(table), table).collect()}
    assert found == reports_by_hand(rows)
    named = table.withColumn("conv_id", F.concat(F.lit("c"), F.col("conv_id").cast("string")))
    assert {r.conv_id for r in repair.repair_report(repair.repair_edits(named)).collect()} == {f"c{r[0]}" if r[0] is not None else None for r in rows}
    assert repair.repair_reports(repair.damaged(table.limit(0)), table.limit(0)).collect() == []


def test_the_edits_are_a_table_of_their_own(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "tool", "It is so."), (1, 3, "user", "cut off"), (2, 0, "system", "Be kind.")]
    edits = repair.repair_edits(spark.createDataFrame(rows, "conv_id int, turn long, role string, text string")).collect()
    assert [(r.conv_id, r.step, r.edit, r.fault, r.new_role, r.cost) for r in sorted(edits)] == [
        (1, 0, "K", "", "user", 0), (1, 1, "D", "duplicate", None, 3), (1, 2, "R", "", "assistant", 2), (1, 3, "D", "truncated", None, 3),
        (2, 0, "D", "", None, 3),
    ]


# ---------------------------------------------------------------- collocations


@pytest.mark.parametrize("longest, id_bits", [(2, 1), (3, 17), (3, 21), (3, 42), (4, 31), (5, 25)])
def test_filters_lose_nothing(longest, id_bits):
    rng = np.random.default_rng(id_bits)
    width = qf.half_width(longest, id_bits)
    columns = [rng.integers(0, min(1 << id_bits, 50), 4000) + ((1 << id_bits) - min(1 << id_bits, 50)) for _ in range(longest)]
    packed = qf.pack(columns, id_bits, width)
    for a, b in zip(qf.unpack(*packed, longest, id_bits, width), columns):
        assert (a == b).all()
    moved = qf.permute(*packed, width)
    assert all((a == b).all() for a, b in zip(qf.restore(*moved, width), packed))
    assert len({*zip(*map(list, moved))}) == len({*zip(*map(list, packed))})
    entries = qf.counted(*moved, width)
    want = Counter(zip(*(m.tolist() for m in moved)))
    assert dict(zip(zip(entries.left.tolist(), entries.right.tolist()), entries.counts.tolist())) == want
    assert list(zip(entries.left.tolist(), entries.right.tolist())) == sorted(want)
    for bits in (0, 1, min(3, width)):
        edges = qf.ranges(entries, bits, width)
        parts = [entries.part(a, b) for a, b in zip(edges, edges[1:])]
        again = [qf.decode(qf.encode(p, width, bits if len(p) else 0), width) for p in parts]
        for p, q in zip(parts, again):
            assert (p.left == q.left).all() and (p.right == q.right).all() and (p.counts == q.counts).all()
    both = qf.merged([entries, qf.counted(moved[0][:500], moved[1][:500], width), qf.nothing()], width)
    assert dict(zip(zip(both.left.tolist(), both.right.tolist()), both.counts.tolist())) == want + Counter(zip(moved[0][:500].tolist(), moved[1][:500].tolist()))


def test_large_counts_and_wide_keys():
    entries = qf.Entries(np.array([1, 2, 3], dtype=np.uint64), np.array([9, 0, 7], dtype=np.uint64), np.array([254, 255, 10**12]))
    assert qf.decode(qf.encode(entries, 63), 63).counts.tolist() == [254, 255, 10**12]
    with pytest.raises(ValueError):
        qf.half_width(3, 43)


def phrases_by_hand(rows, min_count, longest, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(A_TO_Z)):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            totals[lang or "und"] += len(words)
            for n in range(1, longest + 1):
                counts.update((lang or "und", tuple(words[i : i + n])) for i in range(len(words) - n + 1))
    found = {}
    for (lang, p), a in counts.items():
        if len(p) > 1 and a >= min_count:
            cuts = [(10**6 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p))]
            found[lang, p] = (a, min(cuts))
    kept = {}
    for (lang, p), (a, best) in found.items():
        covered = any(
            lang == other and len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            for (other, q), (b, _) in found.items()
        )
        if not covered:
            kept.setdefault(lang, []).append((-best[0], -a, " ".join(p).encode(), best[2], best[3]))
    return {
        (lang, rank, p.decode(), -a, left, right, totals[lang], -score)
        for lang, all_ in kept.items() for rank, (score, a, p, left, right) in enumerate(sorted(all_)[:top], 1)
    }


@pytest.mark.parametrize("longest, block", [(2, 50), (3, 400), (4, 1 << 20)])
def test_collocations_equal_plain_counting(spark, monkeypatch, longest, block):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", block)
    monkeypatch.setattr(collocations, "RANGE_ENTRIES", 64)
    rng = random.Random(longest)
    words = ["new", "york", "City", "the", "of", "É\x00x", "zu", "ß", "a\xa0b", "10"]
    rows = []
    for i in range(120):
        text = " ".join(rng.choices(words, k=rng.randrange(30))).replace("zu", "zu,") + rng.choice(["", ". New York City\tis", "\nnew  york\rcity!", "new york city of the"])
        rows.append((rng.choice(["en", "en", "de", None]), text))
    rows += [("en", None), ("en", ""), ("xx", " \t\n.,"), rows[0], rows[0], ("en", "the of " * 3000)]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, id int, block string").repartition(6)
    monkeypatch.setattr(collocations.blocks, "__defaults__", (block,))
    found = {tuple(r) for r in collocations.collocations(table, min_count=4, longest=longest, top=25).collect()}
    assert found == phrases_by_hand(rows, 4, longest, 25) and len(found) > 40
    assert collocations.collocations(table.limit(0)).collect() == []
    assert collocations.collocations(table.filter("lang = 'xx'")).collect() == []


# ---------------------------------------------------------------- vectors


def nearest_by_hand(rows, k):
    known = {}
    for i, v in rows:
        if i is not None and v is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            known[i] = min(known.get(i, v), v)
    out = set()
    for q, v in known.items():
        if q % 20 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in known.items() if i != q and len(w) == len(v))
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(found[:k], 1)}
    return out


def test_exact_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "LEAF", 8)
    rng = np.random.default_rng(4)
    values = rng.normal(size=(700, 6)) * rng.uniform(0.1, 5, size=(700, 1))
    values[300:420] = values[300]  # many copies
    values[500:520] = -values[300]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(values)]
    rows += [(900, None), (920, [0.0] * 6), (940, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (960, [float("nan")] * 6), (980, [float("inf")] + [0.0] * 5), (None, [1.0] * 6)]
    rows += [(1000 + 20 * i, [float(i), 1.0]) for i in range(5)] + [(2000, [3.0]), (2020, [])]
    rows += [rows[40], (41, rows[42][1])]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, shard int, size int").repartition(4)
    found = vector_search.nearest(table, F.col("vec_id") % 20 == 0, k=20, shard_roots=4)
    got = {tuple(r) for r in found.collect()}
    want = nearest_by_hand(rows, 20)
    near = lambda rows: sorted((q, r, round(s, 9), i) for q, r, i, s in rows)
    assert near(got) == near(want)
    assert vector_search.nearest(table.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_a_relaxed_factor_looks_at_less_and_finds_nearly_all():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(30, 32))
    vectors = centres[rng.integers(0, 30, 6000)] + 0.25 * rng.normal(size=(6000, 32))
    ids, longest = np.arange(6000), float(np.linalg.norm(vectors, axis=1).max())
    tree = vector_search.build(ids, vectors, longest, 21)
    queries = np.arange(0, 6000, 60)
    exact, most = {}, None
    for factor in (1.0, 0.7):
        query, near, _, looked = vector_search.search_tree(tree, queries, vectors[queries], 20, factor)
        pairs = set(zip(query.tolist(), near.tolist()))
        if factor == 1.0:
            exact, most = pairs, looked
            scores = vectors[queries] @ vectors.T
            scores[np.arange(len(queries)), queries] = -np.inf
            want = {(int(q), int(i)) for q, row in zip(queries, np.argsort(-scores, axis=1)[:, :20]) for i in row}
            assert pairs == want
    assert len(pairs & exact) / len(exact) >= 0.9 and looked < 0.85 * most
