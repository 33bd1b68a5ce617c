"""Arithmetic of chances."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def share_split(rows: DataFrame, group: str, rarity: str, shares: Mapping[str, float]) -> DataFrame:
    """``rows`` with ``chance``: the rarity's share divided among the rows of the group that have it."""
    table = F.create_map(*[x for k, v in shares.items() for x in (F.lit(k), F.lit(v))])
    count = F.count("*").over(W.partitionBy(group, F.upper(rarity)))
    return rows.withColumn("chance", F.try_element_at(table, F.upper(rarity)) / count)


def sum_to_one(rows: DataFrame, group: str, chance: str, tolerance: float = 0.005) -> DataFrame:
    """``(group, total)`` of the groups whose known chances don't sum to one; groups without any are left out."""
    return rows.filter(F.col(chance).isNotNull()).groupBy(group).agg(F.sum(chance).alias("total")).filter(F.abs(F.col("total") - 1) > tolerance)


def roster_shares(rows: DataFrame, place: str, roster: str, name: str, weight: str, tier: str) -> DataFrame:
    """``(place, name, chance, tier)``: weight over the roster's total, averaged over the place's rosters, to 4 places.

    Rows without a name count in the total; a roster of total 0 counts among the rosters.
    """
    totals = rows.groupBy(place, roster).agg(F.sum(weight).alias("_total"))
    rosters = totals.groupBy(place).agg(F.count("*").alias("_n"))
    named = rows.filter(F.col(name).isNotNull()).join(totals, [place, roster]).join(rosters, place)
    part = F.when(F.col("_total") > 0, F.col(weight) / F.col("_total") / F.col("_n")).otherwise(0.0)
    return named.groupBy(place, name).agg(F.round(F.sum(part), 4).alias("chance"), F.min(tier).alias("tier"))


def pool_odds(rows: DataFrame, pool: str, entry: str, weight: str, size: str) -> DataFrame:
    """``(pool, entry, odds)``: weight over the pool's total, over the entry's size; equal pools come out once, under the least name."""
    total = F.sum(weight).over(W.partitionBy(pool))
    odds = rows.select(pool, entry, (F.col(weight) / total / F.col(size)).alias("odds"))
    prints = rows.groupBy(pool).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", entry, F.col(weight).cast("string"), F.col(size).cast("string")))), "|"), 256).alias("print"))
    kept = prints.groupBy("print").agg(F.min(pool).alias(pool)).select(pool)
    return odds.join(kept, pool, "left_semi")


def per_roll(table_chance: Column, chance: Column) -> Column:
    """Chance of one try: the table's (1 if not said) times the row's."""
    return F.coalesce(table_chance, F.lit(1.0)) * chance


def expected_tries(chance: Column) -> Column:
    """Tries until the first hit, rounded up; null if it can't be."""
    return F.when(chance > 0, F.ceil(1 / chance))


def rarity_ladder(chance: Column, steps: Mapping[str, float], rest: str) -> Column:
    """The first name whose threshold the chance reaches, from the top down."""
    out = F.lit(rest)
    for name, threshold in sorted(steps.items(), key=lambda x: x[1]):
        out = F.when(chance >= threshold, name).otherwise(out)
    return out


def top_roll(base: Column, disposition: Column) -> Column:
    """The highest value a roll of ``base`` per level can come to: 90 levels, the disposition, and both margins."""
    return F.abs(base) * 90 * disposition * 0.99 * 1.1
