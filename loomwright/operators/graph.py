"""Operators over typed edges ``(edge_ord, src, dst, rel, qty)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.session import cut


def producer(edges: DataFrame, rel: str = "produces") -> DataFrame:
    """``(item, recipe)``: the first recipe that produces an item."""
    return edges.filter(F.col("rel") == rel).groupBy(F.col("dst").alias("item")).agg(F.min_by("src", "edge_ord").alias("recipe"))


def having(nodes: DataFrame, edges: DataFrame, relations: Sequence[str], key: str = "id") -> DataFrame:
    """Nodes that some edge of the relations leads to."""
    reached = edges.filter(F.col("rel").isin(list(relations))).select(F.col("dst").alias(key)).distinct()
    return nodes.join(reached, key, "left_semi")


def rollup(needs: DataFrame, stop: DataFrame | None = None, levels: int = 100) -> DataFrame:
    """``(root, leaf, qty)``: what every item takes in base materials, counts multiplied down and summed.

    ``needs(item, part, qty)`` must have no circle (see ``needing_themselves``). An item is taken apart
    if it has parts and is the root itself or not in ``stop(item)``. Each level is summed by (root,
    item) before the next, so shared parts don't multiply paths. ``levels`` bounds the depth; reaching
    it raises, so a circle can't run on.
    """
    per = cut(needs.groupBy("item", "part").agg(F.sum("qty").alias("qty")))
    apart = per.select("item").distinct()
    if stop is not None:
        apart = apart.join(stop.select("item").distinct(), "item", "left_anti")
    apart = cut(apart.withColumn("_apart", F.lit(True)))
    frontier = per.select(F.col("item").alias("root"), F.col("part").alias("item"), "qty")
    leaves = None
    for _ in range(levels):
        marked = cut(frontier.join(apart, "item", "left"))
        done = marked.filter("_apart is null").select("root", F.col("item").alias("leaf"), "qty")
        leaves = done if leaves is None else leaves.unionByName(done)
        rest = marked.filter("_apart")
        if rest.isEmpty():
            return leaves.groupBy("root", "leaf").agg(F.sum("qty").alias("qty"))
        frontier = (
            rest.select("root", "item", F.col("qty").alias("times")).join(per, "item")
            .groupBy("root", F.col("part").alias("item")).agg(F.sum(F.col("times") * F.col("qty")).alias("qty"))
        )
    raise ValueError(f"deeper than {levels} levels; the parts may be circular")


def needing_themselves(links: DataFrame) -> DataFrame:
    """``(item)`` of ``links(src, dst)`` that can be reached from itself.

    Nodes without a way in or without a way out are in no circle and are taken away round by round;
    what is left is followed from each node until nothing new is reached.
    """
    core = cut(links.select("src", "dst").distinct())
    while True:
        kept = cut(core.join(core.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi").join(core.select(F.col("dst").alias("src")).distinct(), "src", "left_semi").select("src", "dst"))
        if kept.count() == core.count():
            break
        core = kept
    reached = frontier = core.select(F.col("src").alias("root"), F.col("dst").alias("node"))
    while True:
        found = frontier.filter("root <> node").join(core.select(F.col("src").alias("node"), F.col("dst").alias("next")), "node").select("root", F.col("next").alias("node")).distinct()
        frontier = cut(found.join(reached, ["root", "node"], "left_anti"))
        if frontier.isEmpty():
            return reached.filter("root = node").select(F.col("root").alias("item")).distinct()
        reached = cut(reached.unionByName(frontier))


def neighbourhood(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``(id, way, rel, other, label)``: every edge from both its ends, with the other's label."""
    both = edges.select(F.col("src").alias("id"), F.lit("out").alias("way"), "rel", F.col("dst").alias("other")).unionByName(
        edges.select(F.col("dst").alias("id"), F.lit("in").alias("way"), "rel", F.col("src").alias("other"))
    )
    return both.join(labels.select(F.col("id").alias("other"), "label"), "other", "left").select("id", "way", "rel", "other", "label")


def breakdown(edges: DataFrame, bucket: Column) -> DataFrame:
    """``(item, bucket, n)``: edges into each item by bucket."""
    return edges.select(F.col("dst").alias("item"), bucket.alias("bucket")).groupBy("item", "bucket").agg(F.count("*").alias("n"))


def inherited(types: DataFrame, field: str, levels: int = 64) -> DataFrame:
    """``(node, field, depth)``: the value of the nearest of a node and its ancestors that has one, ``levels`` up at most.

    ``types(node, parent, field)`` has one row a node. Nodes whose line has no value keep null.
    """
    known = cut(types.select("node", "parent", F.col(field).alias("value")))
    open_rows = known.filter("value is null and parent is not null").select("node", F.col("parent").alias("at"))
    done = known.filter("value is not null").select("node", F.col("value").alias(field), F.lit(0).alias("depth"))
    for depth in range(1, levels + 1):
        step = cut(open_rows.join(known.select(F.col("node").alias("at"), F.col("parent").alias("up"), "value"), "at"))
        done = done.unionByName(step.filter("value is not null").select("node", F.col("value").alias(field), F.lit(depth).alias("depth")))
        open_rows = step.filter("value is null and up is not null").select("node", F.col("up").alias("at"))
        if open_rows.isEmpty():
            break
    return known.select("node").join(done, "node", "left")


def ordered_pass(seeds: DataFrame, recipes: DataFrame) -> DataFrame:
    """``(item)``: seeds, and what recipes make of them in one pass in their order.

    ``recipes(ord, part, result)``: a recipe counts if it has a part that is a seed or that an earlier
    recipe made. An item's time is the least order at which it is made, so a round that extends by
    later recipes only, until nothing changes, is the single pass.
    """
    when = cut(seeds.select("item").distinct().withColumn("made", F.lit(-1).cast("bigint")))
    frontier = when
    while True:
        made = frontier.join(recipes.select(F.col("part").alias("item"), "ord", "result"), "item").filter(F.col("ord") > F.col("made")).groupBy(F.col("result").alias("item")).agg(F.min("ord").alias("made"))
        better = cut(made.join(when.withColumnRenamed("made", "was"), "item", "left").filter("was is null or made < was").drop("was"))
        if better.isEmpty():
            return when.select("item")
        when = cut(when.unionByName(better).groupBy("item").agg(F.min("made").alias("made")))
        frontier = better


def nested_odds(trees: DataFrame, levels: int = 32) -> DataFrame:
    """``(root, leaf, chance, tier)``: chances multiplied down nested tables, summed by leaf and first roll.

    ``trees(node, child, chance)``; a child without children is a leaf. ``tier`` is the chance of the first roll.
    """
    rows = cut(trees)
    parents = rows.select(F.col("node").alias("child")).distinct().withColumn("_inner", F.lit(True))
    roots = rows.join(rows.select(F.col("child").alias("node")).distinct(), "node", "left_anti")
    frontier = roots.select(F.col("node").alias("root"), "child", "chance", F.col("chance").alias("tier"))
    leaves = None
    for _ in range(levels):
        marked = cut(frontier.join(parents, "child", "left"))
        done = marked.filter("_inner is null").select("root", F.col("child").alias("leaf"), "chance", "tier")
        leaves = done if leaves is None else leaves.unionByName(done)
        rest = marked.filter("_inner")
        if rest.isEmpty():
            return leaves.groupBy("root", "leaf", "tier").agg(F.sum("chance").alias("chance"))
        frontier = rest.select("root", F.col("child").alias("node"), F.col("chance").alias("so_far"), "tier").join(rows, "node").select("root", "child", (F.col("so_far") * F.col("chance")).alias("chance"), "tier")
    raise ValueError(f"nested deeper than {levels}")


def cascade_flag(seeds: DataFrame, steps: Sequence[DataFrame], clear: DataFrame | None = None) -> DataFrame:
    """``(id, flag, step)``: a flag carried over sequential steps of ``(id, of)``, each true if true of all it is made of.

    Seeds are ``(id, flag)``. A step says only of ids not known yet, in the order given. Derived trues
    of ids in ``clear(id)`` become false.
    """
    known = seeds.select("id", "flag", F.lit(0).alias("step"))
    for i, made in enumerate(steps, 1):
        derived = made.join(known.select(F.col("id").alias("of"), "flag"), "of").groupBy("id").agg(F.bool_and("flag").alias("flag"))
        fresh = derived.join(known.select("id"), "id", "left_anti")
        if clear is not None:
            fresh = fresh.join(clear.select("id").distinct().withColumn("_c", F.lit(True)), "id", "left").select("id", (F.col("flag") & F.col("_c").isNull()).alias("flag"))
        known = cut(known.unionByName(fresh.select("id", "flag", F.lit(i).alias("step"))))
    return known


def twins(rows: DataFrame, keys: Sequence[str], key: str, has: str) -> DataFrame:
    """``(key, has)``: rows that share ``keys`` with one that has a value lend it to those that have none."""
    lend = rows.filter(F.col(has).isNotNull()).groupBy(*keys).agg(F.min(has).alias(has))
    return rows.filter(F.col(has).isNull()).drop(has).join(lend, list(keys)).select(key, has)
