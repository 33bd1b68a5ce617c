"""What changed between full snapshots of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loomwright.operators.skew import bounded


def transitions(rows: DataFrame, build: str) -> DataFrame:
    """``(build, steps)``: the comparisons a build takes part in, as its newer side (+1) and as its older (-1).

    A comparison is named by its newer build. The window runs over the distinct builds only, one row a
    delivery, whatever the size of the deliveries.
    """
    builds = rows.select(build).filter(F.col(build).isNotNull()).distinct()
    ordered = W.orderBy(build)
    return builds.select(
        build,
        F.filter(
            F.array(
                F.struct(F.when(F.lag(build).over(ordered).isNotNull(), F.col(build)).alias("step"), F.lit(1).alias("sign")),
                F.struct(F.lead(build).over(ordered).alias("step"), F.lit(-1).alias("sign")),
            ),
            lambda s: s["step"].isNotNull(),
        ).alias("steps"),
    )


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row a key, the one that is greatest by ``order``. Combined before the shuffle, so repeats of one key don't pile up."""
    rest = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_best")
    return rows.groupBy(*keys).agg(best).select(*keys, *[F.col("_best")[c].alias(c) for c in rest])


def _member(cell, name: str):
    """The cell of a set member, as the one-argument function that ``transform`` takes."""
    return lambda value: cell(name, value, F.lit(0))


def diff(
    rows: DataFrame,
    build: str,
    key: str,
    numbers: Mapping[str, float] | None = None,
    values: Sequence[str] = (),
    sets: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Keys added, removed and changed between every two neighbouring builds.

    ``rows`` has one row a build and key (see ``latest``). Each row is unpivoted to cells: a marker
    that the key is present, a cell for every number, value and set member. A cell counts +1 on the
    newer side of a comparison and -1 on the older. Cells whose sums are not zero are what moved.

    ``numbers`` maps a column to the least difference that counts; it needs a value on both sides.
    ``values`` are compared as they are, null being a value of its own. ``sets`` maps a name to an
    array column of strings; null is the empty set and repeats count once.

    Returns ``(build, key, change)`` where change is ``added``, ``removed`` or the name of a field.
    An added or removed key gives that row only. Rows with a null build or key are left out; no rows
    or one build give no rows.
    """
    numbers, sets = dict(numbers or {}), dict(sets or {})
    cell = lambda field, value, amount: F.struct(F.lit(field).alias("field"), value.cast("string").alias("value"), amount.cast("double").alias("amount"))
    none = F.lit(None)
    cells = [F.array(cell("", none, F.lit(0)))]
    cells += [F.when(F.col(c).isNotNull(), F.array(cell(c, none, F.col(c)))).otherwise(F.array().cast("array<struct<field:string,value:string,amount:double>>")) for c in numbers]
    cells += [F.array(cell(c, F.col(c), F.lit(0))) for c in values]
    cells += [F.transform(F.array_distinct(F.coalesce(a, F.array().cast("array<string>"))), _member(cell, n)) for n, a in sets.items()]
    steps = transitions(rows, build)
    # one row a build and key from here on, so a key's rows number its builds at most and all grouping shares this one shuffle
    unpivoted = (
        rows.filter(F.col(build).isNotNull() & F.col(key).isNotNull())
        .select(F.col(build).alias("_build"), F.col(key).alias("key"), F.concat(*cells).alias("cells"))
        .join(bounded(steps.withColumnRenamed(build, "_build")), "_build")
        .repartition("key")
        .select("key", "steps", F.explode("cells").alias("cell"))
        .select("key", F.explode("steps").alias("at"), "cell")
        .select("key", "at.*", "cell.*")
    )
    sums = unpivoted.groupBy("key", "step", "field", "value").agg(
        F.sum("sign").alias("side"), F.sum(F.col("sign") * F.col("amount")).alias("moved"), F.count("*").alias("sides")
    )
    moved = F.lit(False)
    for name, least in numbers.items():
        # sums of decimal fractions carry noise far below any tolerance
        moved |= (F.col("field") == name) & (F.col("sides") == 2) & (F.round(F.abs("moved"), 6) >= least)
    plain = [*values, *sets]
    if plain:
        moved |= F.col("field").isin(plain) & (F.col("side") != 0)
    presence = F.max(F.when(F.col("field") == "", F.col("side")))
    return (
        sums.groupBy("key", "step")
        .agg(presence.alias("presence"), F.array_sort(F.collect_set(F.when(moved, F.col("field")))).alias("fields"))
        .select(
            F.col("step").alias("build"),
            "key",
            F.explode(
                F.when(F.col("presence") > 0, F.array(F.lit("added"))).when(F.col("presence") < 0, F.array(F.lit("removed"))).otherwise(F.col("fields"))
            ).alias("change"),
        )
    )
