"""Data-quality checks and their reports. A finding is ``(layer, rule, entity, detail)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loomwright.operators.skew import bounded

#: Layers in the order they are reported; the first blocks output, the last two stay whatever the scope.
LAYERS = ("invariant", "cross", "outlier", "coverage", "anchor", "silence")
EXEMPT = ("invariant", "silence")


def outliers(rows: DataFrame, group: str, entity: str, value: str, least: int = 8, times: float = 3.0, floor: float = 1.0) -> DataFrame:
    """Rows further than the band from their group's median: ``(group, entity, value, median, band)``.

    The band is ``times`` the scaled median absolute deviation, ``floor`` at least. Groups of fewer
    than ``least`` rows and null values are left out. Groups are few and their medians small, so both
    medians are joined back instead of sorting each group's rows twice in a window.
    """
    kept = rows.filter(F.col(value).isNotNull()).select(group, entity, value)
    middle = bounded(kept.groupBy(group).agg(F.median(value).alias("median"), F.count("*").alias("_n")).filter(F.col("_n") >= least))
    near = kept.join(middle, group)
    band = bounded(near.groupBy(group).agg(F.greatest(F.lit(floor), times * 1.4826 * F.median(F.abs(F.col(value) - F.col("median")))).alias("band")))
    return near.join(band, group).filter(F.abs(F.col(value) - F.col("median")) > F.col("band")).select(group, entity, value, "median", "band")


def compare_sums(ours: DataFrame, theirs: DataFrame, keys: Sequence[str], value: str, tolerance: float) -> DataFrame:
    """``(keys, ours, theirs)`` of the keys in both whose sums differ by more than the tolerance."""
    a = ours.groupBy(*keys).agg(F.sum(value).alias("ours"))
    b = theirs.groupBy(*keys).agg(F.sum(value).alias("theirs"))
    return a.join(b, list(keys)).filter(F.abs(F.col("ours") - F.col("theirs")) > tolerance)


def unwitnessed(ours: DataFrame, theirs: DataFrame, place: str, item: str) -> DataFrame:
    """``(place, item, side)``: pairs that only one side has, at places both sides know."""
    a, b = ours.select(place, item).distinct(), theirs.select(place, item).distinct()
    covered = a.select(place).distinct().join(b.select(place).distinct(), place, "left_semi")
    only = lambda x, y, side: x.join(covered, place, "left_semi").join(y, [place, item], "left_anti").withColumn("side", F.lit(side))
    return only(a, b, "ours").unionByName(only(b, a, "theirs"))


def composition(ours: DataFrame, theirs: DataFrame, group: str, member: str) -> DataFrame:
    """``(group, missing, extra)`` of groups on both sides whose member sets differ; the differences are sorted texts."""
    a = ours.select(group, member).distinct().withColumn("_a", F.lit(1))
    b = theirs.select(group, member).distinct().withColumn("_b", F.lit(1))
    both = a.join(b, [group, member], "full")
    listed = lambda c: F.array_join(F.array_sort(F.collect_list(c)), ",")
    return (
        both.groupBy(group).agg(F.count("_a").alias("na"), F.count("_b").alias("nb"), listed(F.when(F.col("_a").isNull(), F.col(member))).alias("missing"), listed(F.when(F.col("_b").isNull(), F.col(member))).alias("extra"))
        .filter("na > 0 and nb > 0 and (missing <> '' or extra <> '')").select(group, "missing", "extra")
    )


def anchors(expected: DataFrame, actual: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``(key, prop, expected, actual)`` of pinned values that don't hold; null expects nothing, a missing key breaks all its pins."""
    named = actual.select(key, *[F.col(c).cast("string").alias(f"_{c}") for c in columns])
    pins = F.array(*[F.struct(F.lit(c).alias("prop"), F.col(c).cast("string").alias("expected"), F.col(f"_{c}").alias("actual")) for c in columns])
    return expected.join(named, key, "left").select(key, F.inline(pins)).filter("expected is not null and not (expected <=> actual)")


def finding(rows: DataFrame, layer: str, rule: str, entity: Column, detail: Column) -> DataFrame:
    """Rows of a check as findings."""
    return rows.select(F.lit(layer).alias("layer"), F.lit(rule).alias("rule"), entity.cast("string").alias("entity"), detail.cast("string").alias("detail"))


def gather(checks: Sequence[DataFrame]) -> DataFrame:
    """All findings in the order of their checks (``check_ord``)."""
    union = None
    for i, check in enumerate(checks):
        part = check.withColumn("check_ord", F.lit(i))
        union = part if union is None else union.unionByName(part)
    return union


def in_scope(findings: DataFrame, left_out: DataFrame) -> DataFrame:
    """Findings but those on entities left out; exempt layers stay."""
    return findings.filter(F.col("layer").isin(list(EXEMPT))).unionByName(findings.filter(~F.col("layer").isin(list(EXEMPT))).join(left_out.select("entity").distinct(), "entity", "left_anti").select(findings.columns))


def accept(findings: DataFrame, accepted: DataFrame) -> DataFrame:
    """Findings with ``is_open``: false where ``accepted(rule, entity)`` has them."""
    marks = accepted.select("rule", "entity").distinct().withColumn("_ok", F.lit(True))
    return findings.join(bounded(marks), ["rule", "entity"], "left").withColumn("is_open", F.col("_ok").isNull()).drop("_ok")


def report(findings: DataFrame) -> DataFrame:
    """``(layer, rule, n)``, most first."""
    return findings.groupBy("layer", "rule").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "layer", "rule")


def blocked(findings: DataFrame) -> bool:
    """Whether any finding of the first layer forbids output."""
    return not findings.filter(F.col("layer") == LAYERS[0]).isEmpty()


def listed(findings: DataFrame, most: int = 40) -> DataFrame:
    """The first ``most`` findings a rule with the number of those not shown."""
    by = W.partitionBy("rule")
    return findings.withColumn("pos", F.row_number().over(by.orderBy("entity", "detail"))).withColumn("more", F.greatest(F.lit(0), F.count("*").over(by) - most)).filter(F.col("pos") <= most)
