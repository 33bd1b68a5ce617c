"""Joins that tie differently named records to one entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loomwright.operators.skew import bounded


def first_per(rows: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = False) -> DataFrame:
    """The first row a key by ``order`` (or the last), combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    return rows.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def unique_index(rows: DataFrame, name: str, path: str, prefer: Column | None = None) -> DataFrame:
    """``(name, path)`` of the names that one path has; where some rows of a name satisfy ``prefer`` only those count."""
    kept = rows.filter(F.col(name).isNotNull())
    if prefer is None:
        groups = kept.groupBy(name).agg(F.min(path).alias("low"), F.max(path).alias("high"))
    else:
        good = F.when(prefer, F.col(path))
        groups = kept.groupBy(name).agg(F.coalesce(F.min(good), F.min(path)).alias("low"), F.coalesce(F.max(good), F.max(path)).alias("high"))
    return groups.filter("low = high").select(name, F.col("low").alias(path))


def name_index(rows: DataFrame, name: str, path: str) -> DataFrame:
    """``(name, path, ambiguous)``: the least path of each name and whether it has more."""
    groups = rows.filter(F.col(name).isNotNull()).groupBy(name).agg(F.min(path).alias(path), F.max(path).alias("high"))
    return groups.select(name, path, (F.col(path) != F.col("high")).alias("ambiguous"))


def cascade(rows: DataFrame, row: str, steps: Sequence[tuple[str, Column, DataFrame]]) -> DataFrame:
    """``(row, target, how)``: each row by the first step that knows its key.

    A step is (name, key of the row, table ``(key, target)`` with one row a key). Rows no step knows
    keep a null target.
    """
    out = rows
    for i, (_, key, table) in enumerate(steps):
        out = out.withColumn(f"_k{i}", key).join(table.select(F.col("key").alias(f"_k{i}"), F.col("target").alias(f"_t{i}")), f"_k{i}", "left")
    targets = [F.col(f"_t{i}") for i in range(len(steps))]
    how = F.coalesce(*[F.when(t.isNotNull(), F.lit(name)) for t, (name, _, _) in zip(targets, steps)])
    return out.select(row, F.coalesce(*targets).alias("target"), how.alias("how"))


def longest_prefix(rows: DataFrame, key: str, bases: DataFrame, base: str, separator: str = "_") -> DataFrame:
    """``(key, base)``: the longest base that a key starts with, up to a separator or its end.

    A key is unrolled to its prefixes at separators, so the join is on equal keys; no base gives no row.
    """
    parts = F.split(F.col(key), separator)
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), separator))
    unrolled = rows.select(key).distinct().select(key, F.explode(prefixes).alias(base))
    found = unrolled.join(bases.select(base).distinct(), base)
    return found.groupBy(key).agg(F.max_by(base, F.length(base)).alias(base))


def best_overlap(left: DataFrame, right: DataFrame, item: str, key: str, other: str, least: int, ratio: float) -> DataFrame:
    """``(key, other, shared)``: for each left group the right group with most items in common.

    At least ``least`` items, and at least ``ratio`` of the smaller group; of equal ones the least name.
    Both sides are sets: ``left(key, item)``, ``right(other, item)``.
    """
    a, b = left.select(key, item).distinct(), right.select(other, item).distinct()
    shared = a.join(b, item).groupBy(key, other).agg(F.count("*").alias("shared")).filter(F.col("shared") >= least)
    sizes = shared.join(a.groupBy(key).agg(F.count("*").alias("na")), key).join(b.groupBy(other).agg(F.count("*").alias("nb")), other)
    best = first_per(sizes.withColumn("low", -F.col("shared")), [key], ["low", other])
    return best.filter(F.col("shared") >= ratio * F.least("na", "nb")).select(key, other, "shared")


def same_label(rows: DataFrame, key: str, label: str) -> DataFrame:
    """``(key, into)``: keys that share a label with others, and the least of them."""
    groups = rows.filter(F.col(label).isNotNull()).groupBy(label).agg(F.min(key).alias("into"), F.max(key).alias("high")).filter(F.col("into") != F.col("high"))
    return rows.join(groups.select(label, "into"), label).select(key, "into").distinct()


def shortest_sibling(rows: DataFrame, folder: str, name: str) -> DataFrame:
    """``(folder, name, under)``: each name filed under the shortest other name of its folder that it extends.

    Names are unrolled to their own prefixes, so the join is on equal (folder, prefix).
    """
    names = rows.select(folder, name).distinct()
    prefixes = names.select(folder, name, F.explode(F.transform(F.sequence(F.lit(1), F.length(name)), lambda n: F.substring(F.col(name), F.lit(1), n))).alias("under")).filter(F.col("under") != F.col(name))
    return prefixes.join(names.select(folder, F.col(name).alias("under")), [folder, "under"]).groupBy(folder, name).agg(F.min_by("under", F.length("under")).alias("under"))


def supplement(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``first``, and of ``second`` the rows whose key it lacks."""
    return first.unionByName(second.join(first.select(*keys).distinct(), list(keys), "left_anti"))


def pair_link(rows: DataFrame, name: str, key: str, marked: Column) -> DataFrame:
    """``(name, marked_key, plain_key)`` of names with exactly two rows of which exactly one is marked."""
    groups = rows.groupBy(name).agg(
        F.count("*").alias("n"), F.count_if(marked).alias("m"), F.max(F.when(marked, F.col(key))).alias("marked_key"), F.max(F.when(~marked, F.col(key))).alias("plain_key")
    )
    return groups.filter("n = 2 and m = 1").select(name, "marked_key", "plain_key")


def chain(rows: DataFrame, base: str, grade: str, path: str, ordinal: str) -> DataFrame:
    """``(base, path, next)``: each grade linked to the next of its base; of repeats the last path by ``ordinal``."""
    last = rows.groupBy(base, grade).agg(F.max_by(path, ordinal).alias(path))
    return last.join(last.select(base, (F.col(grade) - 1).alias(grade), F.col(path).alias("next")), [base, grade]).select(base, path, "next")


def fill_down(rows: DataFrame, family: Sequence[str], value: str) -> DataFrame:
    """``rows`` with missing values taken from their family, if it has any: the least of them."""
    known = rows.filter(F.col(value).isNotNull()).groupBy(*family).agg(F.min(value).alias("_v"))
    return rows.join(known, list(family), "left").withColumn(value, F.coalesce(value, "_v")).drop("_v")


def attach(rows: DataFrame, nodes: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is a node, and the others, which are reported."""
    return rows.join(nodes.select(key).distinct(), key, "left_semi"), rows.join(nodes.select(key).distinct(), key, "left_anti")


def both_ends(edges: DataFrame, nodes: DataFrame, node: str, source: str = "src", target: str = "dst") -> tuple[DataFrame, DataFrame]:
    """Edges both of whose ends are nodes, and those that dangle with a flag for each end."""
    known = nodes.select(F.col(node).alias("_n")).distinct().withColumn("_there", F.lit(True))
    marked = (
        edges.join(known.withColumnsRenamed({"_n": source, "_there": "_s"}), source, "left").join(known.withColumnsRenamed({"_n": target, "_there": "_t"}), target, "left")
    )
    kept = marked.filter("_s and _t").drop("_s", "_t")
    loose = marked.filter("_s is null or _t is null").withColumn("no_source", F.col("_s").isNull()).withColumn("no_target", F.col("_t").isNull()).drop("_s", "_t")
    return kept, loose


def any_of(parts: Sequence[DataFrame]) -> DataFrame:
    """Membership by any of several joins: their union without repeats, instead of one join on an OR."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.distinct()


def orphan_names(unmatched: DataFrame, name: str, hint: str, order: str) -> DataFrame:
    """``(name, row_count, hint)`` of what no index knew: how often, and the hint of the first."""
    return unmatched.groupBy(name).agg(F.count("*").alias("row_count"), F.min_by(hint, order).alias(hint))


def ranked_unique(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that are alone under their keys."""
    return rows.withColumn("_n", F.count("*").over(W.partitionBy(*keys))).filter("_n = 1").drop("_n")


def lookup_small(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join with a table that is broadcast if it is counted to be small."""
    return rows.join(bounded(table), key, "left")
