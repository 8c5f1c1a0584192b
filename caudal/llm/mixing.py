"""Mixing sources to target weights: a token budget goes down a tree, and each leaf gives a prefix of its seeded epochs.

Budgets. Every child of a node has a weight (whole number). A node's budget is shared among its children by weight, but no
child gets more than its capacity (its tokens times max_epochs); what it cannot take goes to its siblings, by weight. As a
node's capacity is the sum of its leaves', a shortage leaves a subtree only when all siblings there are full: it is made up
among siblings first, then among the ancestors'. Shares are rounded down to whole tokens. All of it is whole numbers.

Selection. A leaf with budget b and t tokens gives b div t whole epochs and, of the next epoch, the longest prefix that fits
in the rest. An epoch's order is the MD5 of seed, epoch and doc_id. The prefix is found from token sums of 4096 slices of that
order; only the slice in which the prefix ends is ordered, so a leaf with a third of all rows is no task of its own.

Defined results: tokens are words; NULL texts have none. A NULL level value is the value ''. Rows with equal doc_id in a leaf
stand at one place of the order and are taken together or not at all. A leaf without tokens, or with weight 0, gives nothing.
A budget beyond the tree's capacity takes everything max_epochs times. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.common import SPACES, stored

SLICE_DIGITS = 3


@dataclass(frozen=True)
class Level:
    """column: gives a document's child at this level. weights: by child; others have `default`."""

    name: str
    column: Column
    weights: dict[str, int] = field(default_factory=dict)
    default: int = 1


def count_words(text: Column) -> Column:
    return F.coalesce(F.size(F.filter(F.split(text, SPACES), lambda w: w != "")), F.lit(0)).cast("bigint")


def _weight(level: Level, key: str) -> Column:
    if not level.weights:
        return F.lit(level.default).cast("bigint")
    pairs = F.create_map(*[F.lit(x) for pair in level.weights.items() for x in pair])
    return F.coalesce(pairs[F.col(key)], F.lit(level.default)).cast("bigint")


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def leaf_budgets(leaves: DataFrame, levels: list[Level], budget: int, max_epochs: int) -> DataFrame:
    """leaves: k0, k1, ..., tokens. Adds budget."""
    keys = [f"k{i}" for i in range(len(levels))]
    root = min(budget, (leaves.agg(F.sum("tokens")).first()[0] or 0) * max_epochs)
    above = None
    for i, level in enumerate(levels):
        node, parent = keys[: i + 1], keys[:i]
        nodes = leaves.groupBy(*node).agg((F.sum("tokens") * max_epochs).alias("cap")).withColumn("w", _weight(level, keys[i]))
        nodes = nodes.withColumn("cap", F.when(F.col("w") > 0, F.col("cap")).otherwise(0))
        nodes = nodes.join(above, parent) if parent else nodes.withColumn("budget", F.lit(root).cast("bigint"))
        inside = Window.partitionBy(*parent)
        order = inside.orderBy((F.col("cap") / F.greatest("w", F.lit(1))), keys[i]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        full = (_exact("cap") * _exact("w_from")) <= ((F.col("budget") - F.col("cap_to") + F.col("cap")).cast("decimal(19,0)") * _exact("w"))
        shared = (
            nodes.withColumn("cap_to", F.sum("cap").over(order))
            .withColumn("w_from", F.sum("w").over(inside) - F.sum("w").over(order) + F.col("w"))
            .withColumn("full", full)
            .withColumn("rest", F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(inside))
            .withColumn("w_rest", F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(inside))
        )
        above = shared.select(*node, F.when(F.col("full"), F.col("cap")).otherwise(F.expr("(cast(w as decimal(19,0)) * cast(rest as decimal(19,0))) div greatest(w_rest, 1L)")).cast("bigint").alias("budget"))
    return leaves.join(above, keys)


def mix(docs: DataFrame, levels: list[Level], budget: int | None = None, budget_percent: int = 60, max_epochs: int = 4, seed: int = 1,
        doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The chosen rows of docs, with tokens and copies (how many epochs take the row). budget: tokens, or a share of all."""
    keys = [f"k{i}" for i in range(len(levels))]
    child = {k: F.coalesce(level.column.cast("string"), F.lit("")) for k, level in zip(keys, levels)}
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    rows = stored(docs.select(*[c.alias(k) for k, c in child.items()], name.alias("name"), count_words(F.col(text)).alias("tokens")), "mix-rows")
    leaves = stored(rows.groupBy(*keys).agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    if budget is None:
        budget = (leaves.agg(F.sum("tokens")).first()[0] or 0) * budget_percent // 100
    some = F.col("tokens") > 0
    plans = leaf_budgets(leaves, levels, budget, max_epochs).select(
        *keys, F.when(some, F.expr("budget div tokens")).otherwise(0).alias("epochs"), F.when(some, F.expr("budget % tokens")).otherwise(0).alias("rest")
    )
    plans = stored(plans, "mix-plans")

    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.col("name")).cast("binary"))
    ordered = rows.join(plans.filter("rest > 0"), keys).withColumn("place", place).withColumn("slice", F.substring("place", 1, SLICE_DIGITS))
    slices = ordered.groupBy(*keys, "slice", "rest").agg(F.sum("tokens").alias("tokens"))
    upto = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slices = slices.withColumn("upto", F.sum("tokens").over(upto))
    last = slices.groupBy(*keys).agg(
        F.max(F.when(F.col("upto") <= F.col("rest"), F.col("slice"))).alias("whole"),
        F.min(F.when(F.col("upto") > F.col("rest"), F.struct("slice", (F.col("upto") - F.col("tokens")).alias("before")))).alias("cut"),
    )
    last = stored(last, "mix-slices")
    inside = Window.partitionBy(*keys).orderBy("place")
    cut = ordered.join(last.filter("cut is not null").select(*keys, "cut"), keys).filter("slice = cut.slice")
    taken = cut.withColumn("upto", F.sum("tokens").over(inside) + F.col("cut.before")).filter(F.col("upto") <= F.col("rest"))
    end = last.join(taken.groupBy(*keys).agg(F.max("place").alias("end")), keys, "left")
    # 'g' sorts after every hexadecimal digit: the end of the last whole slice
    ends = end.select(*keys, F.greatest(F.coalesce("end", F.lit("")), F.coalesce(F.concat("whole", F.lit("g")), F.lit(""))).alias("end"))
    # stored, so that its size is known: documents are not shuffled for it while it is below Spark's broadcast threshold
    plans = stored(plans.join(ends, keys, "left").withColumnsRenamed({k: f"__{k}" for k in [*keys, "epochs", "end"]}).drop("rest"), "mix-ends")

    marked = docs.withColumns({f"__{k}": c for k, c in child.items()})
    marked = marked.join(plans, [f"__{k}" for k in keys])
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("__epochs").cast("string"), name).cast("binary"))
    copies = F.col("__epochs") + F.when(place <= F.coalesce("__end", F.lit("")), 1).otherwise(0)
    chosen = marked.withColumns({"tokens": count_words(F.col(text)), "copies": copies.cast("bigint")}).filter("copies > 0")
    return chosen.select(*[f"`{c}`" for c in docs.columns if c not in ("tokens", "copies")], "tokens", "copies")
