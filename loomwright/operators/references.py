"""References to records that do not exist, or not at the time they are made."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.functions.keys import canonical
from loomwright.operators.skew import lookup


@dataclass(frozen=True)
class Parents:
    """A table that others refer to. Its keys hold from the earliest ``since`` until ``until``."""

    name: str
    frame: DataFrame
    key: str
    since: str
    until: str


@dataclass(frozen=True)
class Children:
    """A table with references: ``key`` names a key of ``parent`` as of ``at``."""

    name: str
    parent: str
    frame: DataFrame
    key: str
    row: str
    at: str


def tagged(parents: Sequence[Parents], children: Sequence[Children]) -> DataFrame:
    """All parent and child keys in one long form. Null and empty keys refer to nothing and are left out."""
    none = F.lit(None).cast("timestamp_ntz")
    parts = [
        p.frame.select(
            F.lit(p.name).alias("parent"), canonical(p.key).alias("key"), F.lit(True).alias("is_parent"),
            F.col(p.since).cast("timestamp_ntz").alias("since"), F.col(p.until).cast("timestamp_ntz").alias("until"),
            F.lit(None).cast("string").alias("ref_table"), F.lit(None).cast("bigint").alias("row_id"), none.alias("at"),
        )
        for p in parents
    ] + [
        c.frame.select(
            F.lit(c.parent).alias("parent"), canonical(c.key).alias("key"), F.lit(False).alias("is_parent"), none.alias("since"), none.alias("until"),
            F.lit(c.name).alias("ref_table"), F.col(c.row).cast("bigint").alias("row_id"), F.col(c.at).cast("timestamp_ntz").alias("at"),
        )
        for c in children
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.filter(F.col("key").isNotNull())


def key_groups(long: DataFrame) -> DataFrame:
    """One row a parent table and key: whether a parent holds it, from when until when, and how many refer to it.

    The groups are combined before the shuffle, so a key with a third of all rows sends a few rows.
    """
    return long.groupBy("parent", "key").agg(
        F.bool_or("is_parent").alias("held"), F.min("since").alias("since"), F.max("until").alias("until"), F.count_if(~F.col("is_parent")).alias("n")
    )


def orphans(parents: Sequence[Parents], children: Sequence[Children]) -> DataFrame:
    """``(ref_table, ref_month, row_id, key)``: every reference whose target is missing at its time.

    That is: no parent row holds the key, or the reference is made before the earliest ``since`` or at
    or after ``until``. A reference without a time counts by its key alone and has a null month.
    Empty tables give no rows; extra columns are ignored.
    """
    long = tagged(parents, children).withColumn("slot", F.concat_ws("\u0001", "parent", "key"))
    groups = key_groups(long).withColumn("slot", F.concat_ws("\u0001", "parent", "key"))
    doubtful = groups.filter(F.col("n") > 0).select("slot", "held", F.col("since").alias("first"), F.col("until").alias("last"))
    rows = long.filter(~F.col("is_parent")).select("slot", "key", "ref_table", "row_id", "at")
    judged = lookup(rows, doubtful, "slot", groups.select("slot", "n"), "inner")
    missing = ~F.col("held") | F.coalesce(F.col("at") < F.col("first"), F.lit(False)) | F.coalesce(F.col("at") >= F.col("last"), F.lit(False))
    return judged.filter(missing).select("ref_table", F.date_format("at", "yyyy-MM").alias("ref_month"), "row_id", "key")


def orphan_report(found: DataFrame) -> DataFrame:
    """``(ref_table, ref_month, orphan_rows, orphan_keys)`` of ``orphans``."""
    by_key = found.groupBy("ref_table", "ref_month", "key").agg(F.count("*").alias("n"))
    return by_key.groupBy("ref_table", "ref_month").agg(F.sum("n").alias("orphan_rows"), F.count("*").alias("orphan_keys"))
