"""Typed tables out of nodes and edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loomwright.operators.resolve import first_per


def edge_table(edges: DataFrame, rel: str, keys: Sequence[str]) -> DataFrame:
    """Edges of one relation with one row a key, the first by (src, rel, dst, edge_ord)."""
    order = [c for c in ("src", "rel", "dst", "edge_ord") if c not in keys]
    return first_per(edges.filter(F.col("rel") == rel), keys, order or ["rel"]) if order else edges.filter(F.col("rel") == rel).dropDuplicates(list(keys))


def long_provenance(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Properties a row as ``(key, prop, value)``; nulls have none."""
    said = F.array(*[F.struct(F.lit(c).alias("prop"), F.col(c).cast("string").alias("value")) for c in columns])
    return rows.select(key, F.inline(said)).filter("value is not null")


def dimension(values: DataFrame, column: str) -> DataFrame:
    """Distinct values with their ordinal from 0, in order. A dimension is small by its nature."""
    return values.select(column).filter(F.col(column).isNotNull()).distinct().withColumn("ordinal", F.row_number().over(W.orderBy(column)) - 1)


def reconciled(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row has; a strict table may not be written while there are any."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def distinct_rows(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The first row by ``order`` of rows alike in all keys; nulls are alike."""
    return first_per(rows, keys, [order])


def offsets(rows: DataFrame, group: str, order: str, size: str) -> DataFrame:
    """Rows with the byte at which each begins when written in order, group by group."""
    before = W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum(size).over(before), F.lit(0)))


def fingerprint(rows: DataFrame, group: str, name: str, content: str) -> DataFrame:
    """``(group, print)``: one hash over the sorted (name, content hash) of a group's files, line ends folded."""
    one = F.concat_ws(":", F.col(name), F.sha2(F.regexp_replace(content, "\r\n", "\n"), 256))
    return rows.groupBy(group).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(one)), "\n"), 256).alias("print"))


def put_new(rows: DataFrame, present: DataFrame, content: str) -> DataFrame:
    """Rows whose content is not stored yet, once each: ``(blob, content)``."""
    named = rows.select(F.sha2(F.col(content), 256).alias("blob"), content)
    return named.dropDuplicates(["blob"]).join(present.select("blob"), "blob", "left_anti")


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """The entries ``(source, logical, blob)`` of each source's latest snapshot."""
    heads = snapshots.groupBy("source").agg(F.max_by("entries", F.struct("created_ms", "id")).alias("entries"))
    return heads.select("source", F.inline("entries"))
