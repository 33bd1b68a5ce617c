"""Best representative of each duplicate group, field by field.

What sources say is judged by a latent two-sided quality model: a fact is a value of a field of one
group; a source that speaks on the field claims the fact or denies it by claiming only others. From
claims and denials alone, expectation-maximisation infers how often each source claims what is true
(sensitivity) and denies what is false (specificity), and how likely each fact is true. A field keeps
every value judged true. Where one value must survive, declared trust comes first, then the latest
word, then the likelier value.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.operators.skew import bounded, fits
from loomwright.session import cut

#: Patterns of claims and denials up to which the driver runs the estimation; sources are few, so patterns are.
PATTERNS = 50_000
ROUNDS, CLOSE = 50, 1e-6
#: Pseudo-counts: how often a source is held to claim the true and to deny the false before anything is seen.
SENSITIVE, SPECIFIC = (4.0, 2.0), (9.0, 1.0)
PRIOR = 0.5
#: Trust of a source that none is declared for.
UNTRUSTED = 1_000_000


def claims(rows: DataFrame, group: Column, source: str, at: str, row: str, fields: Mapping[str, Column]) -> DataFrame:
    """``(grp, prop, val, source, at, row)``: one row a row and field, ``val`` null where it says nothing."""
    said = F.explode(F.array(*[F.struct(F.lit(name).alias("prop"), value.cast("string").alias("val")) for name, value in fields.items()]))
    return (
        rows.select(group.alias("grp"), F.col(source).alias("source"), F.col(at).alias("at"), F.col(row).alias("row"), said.alias("said"))
        .filter(F.col("grp").isNotNull())
        .select("grp", F.col("said.prop").alias("prop"), F.col("said.val").alias("val"), "source", "at", "row")
    )


def facts(said: DataFrame, trust: DataFrame) -> DataFrame:
    """One row a group, field and value: its best claim, its rows and the pattern of who claims and who denies it.

    ``trust`` is ``(source, prop, rank)``. All is combined before it is shuffled, so rows of one hot
    group come down to a row a value. Sources are told apart within a field.
    """
    ranked = said.join(bounded(trust), ["source", "prop"], "left").withColumn("rank", F.coalesce("rank", F.lit(UNTRUSTED)))
    # the time as it is written, whatever the session's zone and its clock changes
    at = F.col("at")
    age = F.date_diff(F.to_date(at), F.lit("1970-01-01").cast("date")).cast("bigint") * 86_400_000_000 + F.hour(at).cast("bigint") * 3_600_000_000 + F.minute(at).cast("bigint") * 60_000_000
    age += (F.extract(F.lit("SECOND"), at).cast("decimal(12,6)") * 1_000_000).cast("bigint")
    newest = F.struct(F.col("rank").alias("rank"), (-age).alias("age"), F.col("row").alias("row"))
    values = ranked.groupBy("grp", "prop", "val").agg(F.min(newest).alias("best"), F.count("*").alias("n"), F.array_sort(F.collect_set("source")).alias("claiming"))
    speaking = ranked.filter(F.col("val").isNotNull()).groupBy("grp", "prop").agg(F.array_sort(F.collect_set("source")).alias("speaking"))
    joined = values.join(speaking, ["grp", "prop"], "left")
    pattern = F.concat_ws("\u0001", "prop", F.array_join(F.transform("speaking", lambda s: F.concat(s, F.when(F.array_contains("claiming", s), "\u0003+").otherwise("\u0003-"))), "\u0002"))
    return joined.withColumn("pattern", F.when(F.col("val").isNotNull(), pattern)).drop("claiming", "speaking")


def _local(counted: list[tuple[str, int]]) -> tuple[dict[str, float], dict[tuple[str, str], tuple[float, float]]]:
    """Expectation-maximisation over counted patterns: likelihood of each, and (sensitivity, specificity) by field and source."""
    parsed = []
    for pattern, _ in counted:
        prop, _, rest = pattern.partition("\u0001")
        parsed.append([((prop, x.split("\u0003")[0]), x.endswith("+")) for x in rest.split("\u0002") if x])
    sources = sorted({s for of in parsed for s, _ in of})
    at = {s: i for i, s in enumerate(sources)}
    yes, no = np.zeros((len(parsed), len(sources))), np.zeros((len(parsed), len(sources)))
    for i, of in enumerate(parsed):
        for s, claimed in of:
            (yes if claimed else no)[i, at[s]] = 1
    n = np.array([c for _, c in counted], float)
    sens, spec = np.full(len(sources), SENSITIVE[0] / sum(SENSITIVE)), np.full(len(sources), SPECIFIC[0] / sum(SPECIFIC))
    true = np.zeros(len(parsed))
    for _ in range(ROUNDS):
        odds = np.log(PRIOR / (1 - PRIOR)) + yes @ (np.log(sens) - np.log1p(-spec)) + no @ (np.log1p(-sens) - np.log(spec))
        before, true = true, 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        t, f = n * true, n * (1 - true)
        sens = (SENSITIVE[0] + t @ yes) / (sum(SENSITIVE) + t @ (yes + no))
        spec = (SPECIFIC[0] + f @ no) / (sum(SPECIFIC) + f @ (yes + no))
        if np.abs(true - before).max(initial=0) < CLOSE:
            break
    return {p: float(x) for (p, _), x in zip(counted, true)}, {s: (float(sens[i]), float(spec[i])) for s, i in at.items()}


def _spread(patterns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same for more patterns than the driver takes, a join and two sums a round."""
    marks = F.explode(F.split(F.substring_index("pattern", "\u0001", -1), "\u0002")).alias("mark")
    seen = cut(
        patterns.select("pattern", "n", F.substring_index("pattern", "\u0001", 1).alias("prop"), marks)
        .select("pattern", "n", "prop", F.substring_index("mark", "\u0003", 1).alias("source"), F.col("mark").endswith("+").alias("claimed"))
    )
    quality = seen.select("prop", "source").distinct().select("prop", "source", F.lit(SENSITIVE[0] / sum(SENSITIVE)).alias("sens"), F.lit(SPECIFIC[0] / sum(SPECIFIC)).alias("spec"))
    likely = None
    for _ in range(ROUNDS):
        weight = F.when(F.col("claimed"), F.ln("sens") - F.ln(1 - F.col("spec"))).otherwise(F.ln(1 - F.col("sens")) - F.ln("spec"))
        odds = seen.join(quality, ["prop", "source"]).groupBy("pattern").agg(F.sum(weight).alias("odds"))
        fresh = cut(odds.select("pattern", (1 / (1 + F.exp(-F.col("odds") - float(np.log(PRIOR / (1 - PRIOR)))))).alias("likely")))
        moved = None if likely is None else fresh.join(likely.withColumnRenamed("likely", "was"), "pattern").agg(F.max(F.abs(F.col("likely") - F.col("was")))).first()[0]
        likely = fresh
        true, false = F.col("n") * F.col("likely"), F.col("n") * (1 - F.col("likely"))
        quality = cut(
            seen.join(likely, "pattern").groupBy("prop", "source").agg(
                ((F.lit(SENSITIVE[0]) + F.sum(F.when(F.col("claimed"), true).otherwise(0.0))) / (F.lit(sum(SENSITIVE)) + F.sum(true))).alias("sens"),
                ((F.lit(SPECIFIC[0]) + F.sum(F.when(~F.col("claimed"), false).otherwise(0.0))) / (F.lit(sum(SPECIFIC)) + F.sum(false))).alias("spec"),
            )
        )
        if moved is not None and moved < CLOSE:
            break
    return likely, quality


def judge(said: DataFrame, trust: DataFrame, patterns: int = PATTERNS) -> tuple[DataFrame, DataFrame]:
    """``facts`` with their likelihood, and ``(prop, source, sensitivity, specificity)``.

    The facts come down to counted patterns, of which there are few where sources are few. They are
    counted; up to ``patterns`` the driver estimates, beyond that the executors do.
    """
    spark = said.sparkSession
    known = cut(facts(said, trust))
    counted = cut(known.filter(F.col("pattern").isNotNull()).groupBy("pattern").agg(F.count("*").alias("n")))
    if fits(counted, patterns):
        likely, quality = _local([(r[0], r[1]) for r in counted.orderBy("pattern").collect()])
        likely = F.broadcast(spark.createDataFrame(list(likely.items()), "pattern string, likely double"))
        quality = spark.createDataFrame([(p, s, a, b) for (p, s), (a, b) in quality.items()], "prop string, source string, sens double, spec double")
    else:
        likely, quality = _spread(counted)
    return known.join(likely, "pattern", "left"), quality.select("prop", "source", F.col("sens").alias("sensitivity"), F.col("spec").alias("specificity"))


def truths(judged: DataFrame, least: float = 0.5) -> DataFrame:
    """``(grp, prop, val, likely)`` of every value judged true: a field may keep several, or none."""
    return judged.filter(F.col("likely") > least).select("grp", "prop", "val", "likely")


def survive(judged: DataFrame, least_rows: int = 2) -> DataFrame:
    """``(grp, prop, val, likely, conflict)``: one surviving value of each field of groups of ``least_rows`` rows or more.

    The claim of the most trusted source wins, of those the latest, of those the likeliest value, of
    those the lowest row. ``conflict`` is 1 if the group says more than one value. A field that no row
    says anything on has no row.
    """
    order = F.struct(F.col("best.rank"), F.col("best.age"), (-F.col("likely")).alias("unlikely"), F.col("best.row"))
    said = F.col("val").isNotNull()
    return (
        judged.groupBy("grp", "prop")
        .agg(
            F.min(F.when(said, F.struct(order.alias("order"), F.col("val"), F.col("likely")))).alias("winner"),
            F.sum("n").alias("rows"), F.count_if(said).alias("values"),
        )
        .filter((F.col("rows") >= least_rows) & (F.col("values") > 0))
        .select("grp", "prop", F.col("winner.val").alias("val"), F.col("winner.likely").alias("likely"), F.when(F.col("values") > 1, 1).otherwise(0).cast("bigint").alias("conflict"))
    )
