"""What a build keeps of the last one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_seen(current: DataFrame, previous: DataFrame, key: str, now: int) -> DataFrame:
    """``(key, since)``: known keys keep their date, new ones begin now, resolved ones are gone."""
    known = previous.groupBy(key).agg(F.min("since").alias("_since"))
    return current.select(key).distinct().join(known, key, "left").select(key, F.coalesce("_since", F.lit(now)).alias("since"))


def settled(since: Column, now: int, days: int = 7) -> Column:
    """Open for more than ``days``; an unknown date counts as settled."""
    return F.coalesce((F.lit(now) - since) > days * 86_400_000, F.lit(True))


def moved(before: DataFrame, after: DataFrame, key: str, value: str, step: float) -> DataFrame:
    """``(key, before, after)`` of keys on both sides whose numbers moved by ``step`` or more."""
    a, b = before.select(key, F.col(value).alias("before")), after.select(key, F.col(value).alias("after"))
    return a.join(b, key).filter(F.abs(F.col("before") - F.col("after")) >= step)


def added_removed(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """``(key, change)`` of keys on one side only."""
    a, b = before.select(key).distinct().withColumn("_a", F.lit(1)), after.select(key).distinct().withColumn("_b", F.lit(1))
    return a.join(b, key, "full").filter("_a is null or _b is null").select(key, F.when(F.col("_a").isNull(), "added").otherwise("removed").alias("change"))


def printed_set(rows: DataFrame, key: str, name: str, chance: str) -> DataFrame:
    """``(key, printed)``: a key's sources as one sorted text of ``name chance%``, each once."""
    line = F.concat(F.col(name), F.lit(" "), F.format_string("%.3f%%", F.col(chance).cast("double") * 100))
    return rows.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(line)), "; ").alias("printed"))


def next_version(version: Column, schema: Column, removed: Column, added: Column, changed: Column) -> Column:
    """The version after a build: the first part is the schema's alone; keys that come or go are a step of the second, changes of the third.

    No version, one that can't be read or one of another schema starts at the schema's first.
    """
    part = lambda i: F.split(version, r"\.")[i].try_cast("int")
    text = lambda *parts: F.concat_ws(".", *[p.cast("string") for p in parts])
    zero = F.lit(0)
    known = version.rlike(r"^[0-9]+\.[0-9]+\.[0-9]+$") & (part(0) == schema)
    return (
        F.when(~F.coalesce(known, F.lit(False)), text(schema, zero, zero)).when((added > 0) | (removed > 0), text(part(0), part(1) + 1, zero))
        .when(changed > 0, text(part(0), part(1), part(2) + 1)).otherwise(version)
    )


def changed_content(current: DataFrame, pinned: DataFrame, key: str, content: str) -> DataFrame:
    """``(key, change)``: what is new or has other content than pinned, by content id, so the rest need not be read again."""
    known = pinned.select(key, F.col(content).alias("_was"))
    return current.select(key, content).join(known, key, "left").filter(f"_was is null or _was <> {content}").select(key, F.when(F.col("_was").isNull(), "new").otherwise("moved").alias("change"))
