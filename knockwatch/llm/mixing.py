"""Mixing sources to target weights: budgets down a tree, then a prefix of each leaf.

Every node passes its budget on to its children by weight. What a child cannot use (its
documents, each taken at most ``max_epochs`` times, have too few tokens) goes to its
siblings; only what all of them cannot use is missing further up, where it goes to the
siblings of the parent. All counts are whole tokens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knockwatch.llm.store import cut

MAX_EPOCHS = 4
#: Least number of documents in a range of a leaf's order; ranges are sorted by themselves.
RANGE_ROWS = 500


def token_count(text: Column) -> Column:
    """Words of a text (runs without ASCII white space)."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def budgets(leaves: DataFrame, levels: Sequence[str], budget: int, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``levels``, ``tokens`` (of each leaf) and ``w_<level>`` (whole weights) → with ``budget``.

    At each node the children are filled up in the order of capacity by weight: a child
    whose share is more than it can use gets what it can use, and the others share the rest
    by weight, rounded down. Children of weight 0 get nothing.
    """
    nodes = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    tree = []
    for depth in range(len(levels), 0, -1):
        path = [*levels[:depth]]
        weight = F.max(f"w_{levels[depth - 1]}").alias("weight")
        usable = F.when(F.col(f"w_{levels[depth - 1]}") > 0, F.col("capacity")).otherwise(0)
        level = cut(nodes.groupBy(*path).agg(F.sum(usable).cast("long").alias("capacity"), weight))
        tree.append((path, level))
        if depth > 1:
            upper = leaves.select(*levels[: depth - 1], f"w_{levels[depth - 2]}").distinct()
            nodes = level.join(upper, [*levels[: depth - 1]]).drop("weight")
    given = None
    for path, level in reversed(tree):
        parent = path[:-1]
        level = level.withColumn("total", F.lit(budget).cast("long")) if given is None else level.join(given, parent)
        given = cut(_shared_out(level, parent).select(*path, F.col("share").alias("total")))
    return leaves.join(given.withColumnRenamed("total", "budget"), [*levels])


def _shared_out(level: DataFrame, parent: list[str]) -> DataFrame:
    """Water-filling among the children of each parent, with exact whole numbers."""
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    key = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(F.lit(float("inf")))
    order = Window.partitionBy(*parent).orderBy(key, *[c for c in level.columns if c not in ("total", "capacity", "weight")])
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    level = level.withColumns(
        {
            "filled": F.sum("capacity").over(upto),
            "others": F.coalesce(F.sum("weight").over(after), F.lit(0)),
        }
    )
    # full when giving this child all it can use leaves each later child no less by its weight
    before = F.col("filled") - F.col("capacity")
    level = level.withColumn(
        "full", wide("capacity") * (F.col("weight") + F.col("others")) <= (F.col("total") - before).cast("decimal(38,0)") * F.col("weight")
    ).withColumn("full", F.col("full") & (F.col("weight") > 0))
    whole = Window.partitionBy(*parent)
    level = level.withColumns(
        {
            "used": F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(whole), F.lit(0)),
            "open": F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole), F.lit(0)),
        }
    )
    rest = F.expr("cast((cast(total - used as decimal(38,0)) * weight) div open as bigint)")
    share = F.when(F.col("full"), F.col("capacity")).when(F.col("open") > 0, F.least(rest, F.col("capacity"))).otherwise(0)
    return level.withColumn("share", share.cast("long"))


def mixture(
    docs: DataFrame,
    levels: dict[str, Column],
    weights: dict[str, Column],
    budget: int | None = None,
    budget_percent: int = 100,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 0,
) -> DataFrame:
    """Each row's ``doc_id, text_hash``, levels, ``tokens, budget`` (of its leaf) and ``copies``.

    ``levels`` names the tree from the top (null is a value of its own), ``weights`` gives
    each level's whole weight as a column. The budget is given, or a percentage of all
    tokens. A leaf takes all its documents as often as they fit into its budget, and of one
    more epoch the longest prefix that still fits, in an order set by a hash of seed, epoch
    and ``doc_id`` (ties by text). Rows without tokens are never taken. Repeated rows are
    counted each by itself but share a place in the order: they are in the prefix together or not at
    all. An empty table gives no rows.
    """
    names = [*levels]
    read = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text"), *[
        F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()
    ])
    counted = cut(read.withColumn("tokens", token_count(F.col("text"))).drop("text"))
    leaves = counted.groupBy(*names).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    leaves = cut(leaves.withColumns({f"w_{n}": weights[n].cast("long") for n in names}))
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    budget = total * budget_percent // 100 if budget is None else budget
    plan = budgets(leaves, names, budget, max_epochs)
    plan = cut(
        plan.select(
            *names,
            "budget",
            F.expr("if(tokens > 0, budget div tokens, 0)").alias("epochs"),
            F.expr("if(tokens > 0, budget % tokens, 0)").alias("rest"),
            # hex digits of the order that name a range: about as many ranges as rows in each
            F.greatest(
                F.lit(0), F.ceil(F.log(16.0, F.col("rows") / F.greatest(F.lit(RANGE_ROWS), F.sqrt("rows"))))
            ).cast("int").alias("digits"),
        )
    )
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    placed = counted.join(plan, names).withColumn("place", order)
    placed = placed.withColumn("range", F.expr("substring(place, 1, digits)"))
    parts = placed.groupBy(*names, "range").agg(F.sum("tokens").alias("part"))
    before = Window.partitionBy(*names).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut(parts.withColumn("before", F.coalesce(F.sum("part").over(before), F.lit(0))).drop("part"))
    inside = Window.partitionBy(*names, "range").orderBy("place", "text_hash")
    ranked = placed.join(parts, [*names, "range"]).withColumn("upto", F.col("before") + F.sum("tokens").over(inside))
    taken = ((F.col("upto") <= F.col("rest")) & (F.col("tokens") > 0)).cast("long")
    copies = F.when(F.col("tokens") > 0, F.col("epochs")).otherwise(0) + taken
    return ranked.select("doc_id", "text_hash", *names, "tokens", "budget", copies.cast("long").alias("copies"))


def take(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as ``plan`` says, with the ``epoch`` of each copy (in place of a column of that
    name); the other columns as they were, whatever they are called."""
    chosen = cut(plan.filter("copies > 0").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "copies").distinct())
    # the row stays in one column while it meets others
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    on = F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("row.text") == F.col("_hash"))
    each = rows.join(chosen, on).select("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    return each.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "epoch"], F.col("copy").alias("epoch"))
