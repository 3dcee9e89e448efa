"""Cheapest repair of a conversation's turns, by a Viterbi search that forgets what is settled.

The roles of a repaired conversation read: perhaps a system turn, then user and assistant in
turn. The search keeps, for each state of that grammar, the cheapest edits so far; of equally
cheap ones the list whose initials come first in ASCII. Edits are nodes of a tree with links
to their predecessors; a node lives while a survivor or another node refers to it. As soon as
all survivors share an ancestor, the edits up to it are settled: they are handed on and
forgotten, with the turns they belong to. So a conversation of any length is read as a
stream; only what is still open is held.

Ties are broken by the whole of the unresolved edits, yet in constant time: how the
survivors' lists compare is known at each step, and a list that grows by an edit keeps that
order (no list of equal cost is the beginning of another, since inserting costs something).
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The costs and the initials of the edits.
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
FAULTS = ["", "blank", "duplicate", "truncated"]
SPACES = " \t\n\x0b\x0c\r"

LEGAL = {"su", "ua", "au"}
ROWS_AT_ONCE = 2000

# States of the grammar: nothing yet, a system turn, a user turn last, an assistant turn last.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: The state after each state and kind of turn.
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: What it costs at most more to go on from the state after an assistant turn than from these: at a system turn kept
#: later, deleting it. A survivor that lags by more is dropped: it can win no more, and would keep all edits open.
BEHIND = {START: DELETE_COST, SYSTEM: 0}
#: The role that a changed or inserted turn must have in each state.
WANTED = {START: "user", SYSTEM: "user", ASSISTANT: "user", USER: "assistant"}

EDITS = (
    "conv_id string, step long, edit string, fault string, turn long, role string, new_role string, new_text string, cost int"
)


class _Node:
    """An edit; ``refs`` counts the survivors and later edits that refer to it."""

    __slots__ = ("parent", "edit", "kids", "held")

    def __init__(self, parent: _Node | None, edit: str):
        self.parent, self.edit, self.kids, self.held = parent, edit, [], 0


def _release(node: _Node) -> None:
    """Free a node that nothing refers to, and what only it referred to."""
    while node.parent is not None and not node.kids and not node.held:
        parent = node.parent
        parent.kids.remove(node)
        node = parent


@dataclass
class _Survivor:
    cost: int
    node: _Node


class Repair:
    """The search over one conversation: turns go in, settled edits come out."""

    def __init__(self) -> None:
        self.root = _Node(None, "")
        self.root.held = 1
        self.alive: dict[int, _Survivor] = {START: _Survivor(0, self.root)}
        # (edits of state i, edits of state j) → how they compare; beside -1 and 1, the number of
        # inserts by which one list goes on where the other ends, as ("I", n) or ("-I", n)
        self.order: dict[tuple[int, int], int | tuple[str, int]] = {}
        self.open = 0
        self._insert()

    def _compare(self, a: tuple[int, str], b: tuple[int, str]) -> int | tuple[str, int]:
        """How two lists compare: each is that of a survivor and a few more edits."""
        (i, more_i), (j, more_j) = a, b
        if i != j:
            known = self.order[i, j]
            if isinstance(known, int):
                return known
            kind, n = known
            if kind == "I":  # the second goes on
                more_j = INSERT * n + more_j
            else:
                more_i = INSERT * n + more_i
        if more_j.startswith(more_i) and more_i != more_j:
            rest = more_j[len(more_i) :]
            return ("I", len(rest)) if set(rest) == {INSERT} else -1
        if more_i.startswith(more_j) and more_i != more_j:
            rest = more_i[len(more_j) :]
            return ("-I", len(rest)) if set(rest) == {INSERT} else 1
        return (more_i > more_j) - (more_i < more_j)

    def _advance(self, found: dict[int, list[tuple[int, int, str]]]) -> None:
        """From candidates (cost, state before, edits) for each state to the new survivors."""
        best = {}
        for state, candidates in found.items():
            chosen = candidates[0]
            for other in candidates[1:]:
                if other[0] < chosen[0] or (other[0] == chosen[0] and self._compare(other[1:], chosen[1:]) == -1):
                    chosen = other
            best[state] = chosen
        order = {(i, j): self._compare(best[i][1:], best[j][1:]) for i in best for j in best if i != j}
        old = self.alive
        alive, grown = {}, {}
        for state, (cost, before, edits) in best.items():
            node = old[before].node
            for at, edit in enumerate(edits):
                key = (before, edits[: at + 1])
                if key not in grown:
                    kid = _Node(node, edit)
                    node.kids.append(kid)
                    grown[key] = kid
                node = grown[key]
            node.held += 1
            alive[state] = _Survivor(cost, node)
        for survivor in old.values():
            survivor.node.held -= 1
            _release(survivor.node)
        self.alive, self.order = alive, order

    def _insert(self) -> None:
        """Survivors that go on by inserted turns; two reach every state that any number reaches."""
        found = {state: [(s.cost, state, "")] for state, s in self.alive.items()}
        for origin, survivor in self.alive.items():
            state = origin
            for n in (1, 2):
                state = AFTER[state, WANTED[state][0]]
                found.setdefault(state, []).append((survivor.cost + n * INSERT_COST, origin, n * INSERT))
        self._advance(found)
        for state, behind in BEHIND.items():
            if state in self.alive and self.alive[state].cost > self.alive[ASSISTANT].cost + behind:
                node = self.alive.pop(state).node
                node.held -= 1
                _release(node)

    def add(self, initial: str, must_go: bool, truncated: bool) -> list[str]:
        """One more turn; returns the edits that are settled now."""
        found: dict[int, list[tuple[int, int, str]]] = {}

        def offer(state: int, cost: int, before: int, edit: str) -> None:
            found.setdefault(state, []).append((cost, before, edit))

        extra = TRUNCATED_COST if truncated else 0
        for state, survivor in self.alive.items():
            offer(state, survivor.cost + DELETE_COST, state, DELETE)
            if not must_go:
                if (state, initial) in AFTER:
                    offer(AFTER[state, initial], survivor.cost + extra, state, KEEP)
                offer(AFTER[state, WANTED[state][0]], survivor.cost + REROLE_COST + extra, state, REROLE)
        self._advance(found)
        self._insert()
        return self._settled()

    def _settled(self) -> list[str]:
        edits = []
        while not self.root.held and len(self.root.kids) == 1:
            self.root = self.root.kids[0]
            self.root.parent = None
            edits.append(self.root.edit)
        return edits

    def finish(self) -> tuple[list[str], int]:
        """The edits left, and the cost of all."""
        end = None
        for state in ENDS:
            if state in self.alive and (
                end is None
                or self.alive[state].cost < self.alive[end].cost
                or (self.alive[state].cost == self.alive[end].cost and self._compare((state, ""), (end, "")) == -1)
            ):
                end = state
        node, edits = self.alive[end].node, []
        while node.parent is not None:
            edits.append(node.edit)
            node = node.parent
        return edits[::-1], self.alive[end].cost


class _Conversation:
    """Turns of one conversation in, rows of ``EDITS`` out."""

    def __init__(self, conv_id: str | None):
        self.conv_id, self.search, self.waiting = conv_id, Repair(), deque()
        self.state, self.step, self.last = START, 0, None

    def turn(self, turn: int | None, role: str, text: str, fault: int, in_first_turn: bool, digest: str) -> list[tuple]:
        # equal rows of one turn are neighbours; the first of them, in the first turn, repeats nothing
        if fault == 2 and in_first_turn and self.last != (turn, digest):
            fault = 3 if _is_truncated(text) else 0
        self.last = (turn, digest)
        self.waiting.append((turn, role, text, fault))
        return self._rows(self.search.add(role[:1], fault in (1, 2), fault == 3))

    def end(self) -> list[tuple]:
        edits, _ = self.search.finish()
        return self._rows(edits)

    def _rows(self, edits: list[str]) -> list[tuple]:
        rows = []
        for edit in edits:
            wanted = WANTED[self.state]
            if edit == INSERT:
                row, new, cost = (None, None, "", 0), (wanted, ""), INSERT_COST
            else:
                row = self.waiting.popleft()
                late = TRUNCATED_COST if row[3] == 3 else 0
                new, cost = {
                    KEEP: ((row[1], row[2]), late), REROLE: ((wanted, row[2]), REROLE_COST + late), DELETE: ((None, None), DELETE_COST),
                }[edit]
            if new[0] is not None:
                self.state = AFTER[self.state, new[0][:1]]
            turn, role, _, fault = row
            rows.append((self.conv_id, self.step, edit, FAULTS[fault], turn, role, *new, cost))
            self.step += 1
        return rows


def _is_truncated(text: str) -> bool:
    last = text.rstrip(SPACES)
    return last[-1:] not in (".", "!", "?")


def with_faults(turns: DataFrame) -> DataFrame:
    """``turns`` (``conv_id, turn, role, text``, no null role or text) with ``fault`` (the place in ``FAULTS``),
    ``digest`` of role and text, and the ``first_turn`` of those that occur more than once.

    Rows that occur again are known by counting digests per conversation, before and after
    the shuffle; only what repeats comes back to the rows. All of its rows have the fault
    here: which one is the first is told by ``first_turn`` and, within a turn, by the order.
    """
    text = F.col("text")
    digest = F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text"))
    marked = turns.select("conv_id", "turn", "role", "text", digest.alias("digest"))
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = marked.groupBy("conv_id", "digest").agg(F.count(F.lit(1)).alias("times"), F.min(order).alias("first"))
    again = again.filter("times > 1").select(F.col("conv_id").alias("its_conv"), F.col("digest").alias("its_digest"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("its_conv")) & (F.col("digest") == F.col("its_digest"))
    joined = marked.join(again, same, "left")
    last = F.substring(F.rtrim(text, F.lit(SPACES)), -1, 1)
    repeats = F.col("first").isNotNull()
    fault = F.when(last == "", 1).when(repeats, 2).when(~last.isin(".", "!", "?"), 3).otherwise(0)
    return joined.select("conv_id", "turn", "role", "text", "digest", fault.alias("fault"), F.col("first.turn").alias("first_turn"))


def repair_edits(turns: DataFrame) -> DataFrame:
    """The cheapest edits of every conversation, a row each in order: ``EDITS``.

    ``step`` counts a conversation's edits from 0. ``role`` is the turn's own (null for an
    inserted one), ``new_role`` and ``new_text`` those after the repair (null for a deleted
    one). Turns are taken by ``turn``, nulls first, then by role and text. Null roles and
    texts are empty. Other columns are not looked at; an empty table gives no rows. Rows of
    a conversation are neighbours in one partition, in order: the repaired text of a
    conversation is a sequence, so one task reads it, as a stream out of Spark's own sort.
    """
    known = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    in_order = (
        with_faults(known)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
        .select(
            F.col("conv_id").cast("string").alias("conv_id"),
            F.col("turn").isNotNull().alias("has_turn"),
            F.coalesce("turn", F.lit(0).cast("long")).alias("turn"),
            "role", "text", "digest", "fault",
            F.col("turn").eqNullSafe(F.col("first_turn")).alias("in_first_turn"),
        )
    )

    def found(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conversation, rows = None, []
        for table in tables:
            for conv_id, has_turn, turn, role, text, digest, fault, in_first_turn in table.itertuples(index=False, name=None):
                if conversation is None or conv_id != conversation.conv_id:
                    if conversation is not None:
                        rows += conversation.end()
                    conversation = _Conversation(conv_id)
                rows += conversation.turn(turn if has_turn else None, role, text, fault, in_first_turn, digest)
                if len(rows) >= ROWS_AT_ONCE:
                    yield _frame(rows, EDITS)
                    rows = []
        if conversation is not None:
            rows += conversation.end()
        yield _frame(rows, EDITS)

    edits = in_order.mapInPandas(found, EDITS)
    return edits.withColumn("conv_id", F.col("conv_id").cast(turns.schema["conv_id"].dataType))


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")], dtype=object)


@dataclass
class _Report:
    """What is known of a conversation whose edits come by."""

    conv_id: str | None
    low: int | None = None
    high: int | None = None
    turns: int = 0
    illegal: int = 0
    cost: int = 0
    before: str | None = None

    def __post_init__(self) -> None:
        self.faults, self.audit, self.text, self.empty = dict.fromkeys(FAULTS, 0), bytearray(), hashlib.sha256(), True

    def add(self, edit: str, fault: str, turn: int | None, role: str, new_role: str | None, new_text: str, cost: int) -> None:
        self.cost += cost
        self.audit += edit.encode()
        if edit != INSERT:
            self.faults[fault] += 1
            self.illegal += self.before is not None and self.before + role[:1] not in LEGAL
            self.before = role[:1]
            if turn is not None and turn != self.high:
                self.turns += 1
                self.low, self.high = turn if self.low is None else self.low, turn
        if new_role is not None:
            start = "" if self.empty else "\n"
            self.text.update(f"{start}{new_role}:{new_text}".encode("utf-8", "surrogatepass"))
            self.empty = False

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        faults = (self.faults[f] for f in FAULTS[1:])
        return (self.conv_id, gaps, *faults, self.illegal, self.cost, self.audit.decode(), self.text.hexdigest())


REPORT = (
    "conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string,"
    " repaired_sha256 string"
)


def repair_report(edits: DataFrame) -> DataFrame:
    """One row for each conversation of ``repair_edits``, from the same partitions: ``REPORT``.

    The digest of the repaired text is taken as the edits come by; no conversation is held.
    """
    columns = [
        F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").isNotNull().alias("has_turn"),
        F.coalesce("turn", F.lit(0).cast("long")).alias("turn"), "edit", "fault", "role", "new_role", "new_text", "cost",
    ]

    def found(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        report, out = None, []
        for table in tables:
            for conv_id, has_turn, turn, edit, fault, *rest in table.itertuples(index=False, name=None):
                if report is None or conv_id != report.conv_id:
                    if report is not None:
                        out.append(report.row())
                    report = _Report(conv_id)
                report.add(edit, fault, turn if has_turn else None, *rest)
                if len(out) >= ROWS_AT_ONCE:
                    yield _frame(out, REPORT)
                    out = []
        if report is not None:
            out.append(report.row())
        yield _frame(out, REPORT)

    reports = edits.select(*columns).mapInPandas(found, REPORT)
    return reports.withColumn("conv_id", F.col("conv_id").cast(edits.schema["conv_id"].dataType))


def repair_reports(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """``REPORT`` for every distinct ``conv_id`` of ``ids``; one without turns has zeros and nothing to repair."""
    every = ids.select(F.col("conv_id").alias("original")).distinct()
    report = repair_report(repair_edits(turns))
    joined = every.join(report, F.col("original").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    counts = [c.split()[0] for c in REPORT.split(", ")][1:7]
    return joined.select(
        F.col("original").alias("conv_id"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage, by ``crc32(conv_id:turn) % 20``; a null in any column is one space."""

    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    marked = turns.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    kept = marked.filter("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy"))
    return kept.drop("copy")
