"""Claims of several sources on one property, resolved with their provenance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.operators.skew import bounded


def resolve(claims: DataFrame, priority: DataFrame) -> DataFrame:
    """One row an ``(entity, prop)``: ``value, winner, sources, status`` of ``claims(entity, prop, source, value, ord)``.

    The claim of the source with the lowest ``priority(prop, source, rank)`` wins; sources without a
    rank come after all with one, and among equals the claim asked first (``ord``). ``sources`` has
    every source once in the order asked. Status is ``conflict`` if values differ (even of one
    source), ``confirmed`` if two sources or more agree, else ``single``. Null values are no claims.
    """
    ranked = claims.filter(F.col("value").isNotNull()).join(bounded(priority), ["prop", "source"], "left")
    # a source's first claim stands for it, so what is shuffled is a row a source
    by_source = ranked.groupBy("entity", "prop", "source").agg(
        F.min(F.struct(F.coalesce("rank", F.lit(2**31 - 1)).alias("rank"), F.col("ord"), F.col("value"))).alias("first"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    groups = by_source.groupBy("entity", "prop").agg(
        F.min(F.struct(F.col("first.rank"), F.col("first.ord"), F.col("first.value"), F.col("source"))).alias("win"),
        F.array_sort(F.collect_list(F.struct(F.col("first.ord"), F.col("source")))).alias("asked"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    )
    sources = F.transform("asked", lambda x: x["source"])
    status = F.when(F.col("low") != F.col("high"), "conflict").when(F.size("asked") > 1, "confirmed").otherwise("single")
    return groups.select("entity", "prop", F.col("win.value").alias("value"), F.col("win.source").alias("winner"), F.array_join(sources, ",").alias("sources"), status.alias("status"))


def conflict_claims(claims: DataFrame, resolved: DataFrame) -> DataFrame:
    """Conflicting properties with all their claims printed in the order asked, and what was chosen."""
    conflicts = resolved.filter(F.col("status") == "conflict").select("entity", "prop", F.col("value").alias("chosen"))
    printed = claims.filter(F.col("value").isNotNull()).groupBy("entity", "prop").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "source", "value"))), lambda x: F.concat(x["source"], F.lit("="), x["value"])), " ").alias("detail")
    )
    return conflicts.join(printed, ["entity", "prop"])


def tally_never_confirmed(resolved: DataFrame, group: str) -> DataFrame:
    """``(group, prop, n)`` where a property was said at least once and no two sources ever agreed."""
    counts = resolved.groupBy(group, "prop").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "confirmed").alias("confirmed"))
    return counts.filter("confirmed = 0").drop("confirmed")


def only_value(rows: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, value)`` of the groups that say exactly one value; nulls say nothing."""
    return rows.groupBy(key).agg(F.min(value).alias("low"), F.max(value).alias("high")).filter("low = high").select(key, F.col("low").alias(value))


def majority(rows: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, value, votes)``: the value most rows of a group have; of equal ones the last in order."""
    votes = rows.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("votes"))
    return votes.groupBy(key).agg(F.max(F.struct("votes", value)).alias("top")).select(key, F.col(f"top.{value}").alias(value), F.col("top.votes").alias("votes"))


def ambiguity(rows: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, kind, n, first)``: ``map`` if a key has one value, ``verbatim`` if that is the key itself, else ``ambiguous``."""
    pairs = rows.filter(F.col(value).isNotNull()).select(key, value).distinct()
    groups = pairs.groupBy(key).agg(F.count("*").alias("n"), F.min(value).alias("first"))
    return groups.withColumn("kind", F.when(F.col("n") > 1, "ambiguous").when(F.col("first") == F.col(key), "verbatim").otherwise("map"))


def reconcile(first: Column, second: Column) -> tuple[Column, Column]:
    """Two spellings of a name as ``(name, status)``, ``first`` being the authority's and ``second`` one that may decorate it.

    Equal or different in case only: the first, confirmed. The second is the first with a
    parenthetical more: the second, confirmed; the other way round is a conflict, since only the second
    decorates. One missing: the other, single. Else the first, in conflict.
    """
    same = F.lower(first) == F.lower(second)
    more = F.trim(F.substr(second, F.length(first) + 1))
    decorated = F.lower(second).startswith(F.lower(first)) & more.startswith("(") & more.endswith(")")
    name = F.when(first.isNull(), second).when(second.isNull() | same, first).when(decorated, second).otherwise(first)
    status = F.when(first.isNull() | second.isNull(), "single").when(same | decorated, "confirmed").otherwise("conflict")
    return name, status


def overlay(base: DataFrame, decisions: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``base`` with the columns that a decision gives; a later decision (``ord``) replaces an earlier, nulls decide nothing."""
    last = decisions.groupBy(key).agg(*[F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col("ord"))).alias(f"_{c}") for c in columns])
    return base.join(last, key, "left").select(*[F.coalesce(f"_{c}", c).alias(c) if c in columns else c for c in base.columns])


def claims_of(rows: DataFrame, entity: str, prop: str, sources: Mapping[str, Column]) -> DataFrame:
    """Columns as claims in long form, asked in the order given."""
    said = F.array(*[F.struct(F.lit(name).alias("source"), value.cast("string").alias("value"), F.lit(i).alias("ord")) for i, (name, value) in enumerate(sources.items())])
    return rows.select(F.col(entity).cast("string").alias("entity"), F.lit(prop).alias("prop"), F.inline(said)).filter(F.col("value").isNotNull())
