"""Ordered rule tables: the first rule that matches a row decides."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a matcher's values are compared with: equal, start or part.
MATCHERS: dict[str, Callable[[Column, str], Column]] = {
    "is": lambda c, v: c == F.lit(v),
    "starts": lambda c, v: c.startswith(v),
    "contains": lambda c, v: c.contains(v),
    "word": lambda c, v: F.array_contains(F.split(c, r"\s+"), v),
}


@dataclass(frozen=True)
class Rule:
    """``when`` maps ``column:matcher`` to values: every matcher must hit, any of its values suffices, none means all rows."""

    result: str
    when: dict[str, Sequence[str]] = field(default_factory=dict)
    fallback: bool = False

    def hits(self) -> Column:
        test = F.lit(True)
        for name, values in self.when.items():
            column, _, how = name.partition(":")
            if values:
                any_of = F.lit(False)
                for value in values:
                    any_of |= F.coalesce(MATCHERS[how or "is"](F.col(column), value), F.lit(False))
                test &= any_of
        return test


def decide(rows: DataFrame, rules: Sequence[Rule], default: str = "unknown") -> DataFrame:
    """``rows`` with ``rule`` (its number from 0, null if none matches) and ``result``.

    The rules become one CASE, which stays inside generated code; a null never matches.
    """
    number = F.lit(None).cast("int")
    for i in range(len(rules) - 1, -1, -1):
        number = F.when(rules[i].hits(), F.lit(i)).otherwise(number)
    decided = rows.withColumn("rule", number)
    results = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(i), F.lit(r.result))]) if rules else None
    return decided.withColumn("result", F.coalesce(F.try_element_at(results, F.col("rule")), F.lit(default)) if rules else F.lit(default))


def dead(decided: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(rule, result)`` of the rules that decided nothing, fallbacks aside."""
    spark: SparkSession = decided.sparkSession
    listed = spark.createDataFrame([(i, r.result) for i, r in enumerate(rules) if not r.fallback], "rule int, result string")
    return listed.join(decided.select("rule").distinct(), "rule", "left_anti")


def provisional(rules: Sequence[Rule]) -> list[str]:
    """Results that only fallback rules give."""
    return sorted({r.result for r in rules if r.fallback} - {r.result for r in rules if not r.fallback})
