"""Filters, facets, pages and searches over a catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from loomwright.functions.text import fuzzy_fold, search_fold
from loomwright.operators.skew import bounded


def contains_text(query: str, *columns: str) -> Column:
    """Rows any of whose columns has the trimmed query in any case; an empty query has all."""
    wanted = query.strip().lower()
    if not wanted:
        return F.lit(True)
    test = F.lit(False)
    for c in columns:
        test |= F.coalesce(F.lower(F.col(c)).contains(wanted), F.lit(False))
    return test


def facets(rows: DataFrame, predicates: Mapping[str, Column], kept: Column | None = None) -> DataFrame:
    """``(facet, n)``: rows by each predicate with the other filters kept, in one pass."""
    counted = (rows if kept is None else rows.filter(kept)).agg(*[F.count_if(p).alias(name) for name, p in predicates.items()])
    return counted.select(F.inline(F.array(*[F.struct(F.lit(name).alias("facet"), F.col(name).alias("n")) for name in predicates])))


def page(rows: DataFrame, order: Sequence[Column], at: int, limit: int) -> DataFrame:
    """Rows ``at`` on, ``limit`` of them (0: all); a start past the end is the start."""
    ordered = rows.orderBy(*order)
    if at and rows.count() <= at:
        at = 0
    ordered = ordered.offset(at) if at else ordered
    return ordered.limit(limit) if limit else ordered


def pivot_counts(rows: DataFrame, group: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of a column's fixed values side by side, a row a group."""
    return rows.groupBy(group).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])


def capped(rows: DataFrame, group: str, order: Sequence[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each group with ``overflow``, the number left out."""
    by = W.partitionBy(group)
    return rows.withColumn("pos", F.row_number().over(by.orderBy(*order))).withColumn("overflow", F.greatest(F.lit(0).cast("bigint"), F.count("*").over(by) - most)).filter(F.col("pos") <= most)


def inverted_index(rows: DataFrame, key: str, fields: Mapping[str, str]) -> DataFrame:
    """``(token, key, field, times)``: folded words of each field."""
    parts = F.array(*[F.struct(F.lit(name).alias("field"), F.split(F.trim(F.regexp_replace(search_fold(F.col(c)), r"[^\p{L}\p{N}]+", " ")), " ").alias("words")) for name, c in fields.items()])
    return rows.select(key, F.inline(parts)).select(key, "field", F.explode("words").alias("token")).filter("token <> ''").groupBy("token", key, "field").agg(F.count("*").alias("times"))


def index_hits(index: DataFrame, key: str, query: str) -> DataFrame:
    """``(key, words, times)`` of the keys that have every word of the query."""
    words = sorted({w for w in query.lower().replace("ё", "е").split() if w})
    found = index.filter(F.col("token").isin(words)).groupBy(key).agg(F.count_distinct("token").alias("words"), F.sum("times").alias("times"))
    return found.filter(F.col("words") == len(words))


def _jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    taken, matched = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                matched.append(c)
                break
    if not matched:
        return 0.0
    m = len(matched)
    swaps = sum(x != y for x, y in zip(matched, (c for c, t in zip(b, taken) if t))) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


@F.pandas_udf(T.DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaro-Winkler likeness, prefix scale 0.1 over 4 letters at most, for likeness over 0.7."""
    return pd.Series([None if x is None or y is None else _jaro_winkler(x, y) for x, y in zip(a, b)], dtype="float64")


def similarity(a: Column, b: Column) -> Column:
    """0 to 100: the better of Jaro-Winkler and shared words over the larger word set, of folded texts."""
    x, y = fuzzy_fold(a), fuzzy_fold(b)
    words = lambda c: F.array_distinct(F.split(c, " "))
    shared = F.size(F.array_intersect(words(x), words(y))) / F.greatest(F.size(words(x)), F.size(words(y)))
    return F.round(100 * F.greatest(jaro_winkler(x, y), shared)).cast("bigint")


def candidates(queries: DataFrame, names: DataFrame, query: str, name: str) -> DataFrame:
    """``(query, name)`` pairs worth scoring: names with a word of the query, else with its first letter.

    Queries are met by equal words, then the rest by equal first letters: no query is compared with all names.
    """
    fold = lambda frame, c: frame.select(c).distinct().withColumn("_f", fuzzy_fold(F.col(c))).filter("_f <> ''")
    q, n = fold(queries, query), fold(names, name)
    words = lambda frame, c: frame.select(c, F.explode(F.array_distinct(F.split("_f", " "))).alias("_w"))
    by_word = words(q, query).join(words(n, name), "_w").select(query, name).distinct()
    rest = q.join(by_word.select(query).distinct(), query, "left_anti")
    letter = lambda frame, c: frame.select(c, F.substring("_f", 1, 1).alias("_l"))
    return by_word.unionByName(letter(bounded(rest), query).join(letter(n, name), "_l").select(query, name))


def top_hits(queries: DataFrame, names: DataFrame, query: str, name: str, least: int, most: int, strict: bool = True) -> DataFrame:
    """``(query, name, score, pos)``: the ``most`` best names of each query over ``least`` (or at it, if not strict)."""
    scored = candidates(queries, names, query, name).withColumn("score", similarity(F.col(query), F.col(name)))
    kept = scored.filter(F.col("score") > least if strict else F.col("score") >= least)
    order = W.partitionBy(query).orderBy(F.desc("score"), F.octet_length(name), name)
    return kept.withColumn("pos", F.row_number().over(order)).filter(F.col("pos") <= most)
