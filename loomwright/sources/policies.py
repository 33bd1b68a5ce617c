"""Small policy files: TOML tables as DataFrames with a fixed schema."""

from __future__ import annotations

import os
import tomllib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from loomwright.operators.rules import Rule


def read_toml(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    """The rows of one array of tables in their order; a missing file or table is empty, fields not in the schema are left out."""
    rows: list[dict] = []
    if os.path.exists(path):
        with open(path, "rb") as file:
            rows = tomllib.load(file).get(table, [])
    names = [part.split()[0] for part in _fields(schema)]
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)


def _fields(schema: str) -> Sequence[str]:
    depth, out, start = 0, [], 0
    for i, c in enumerate(schema):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            out.append(schema[start:i].strip())
            start = i + 1
    return [*out, schema[start:].strip()]


def rules_of(rows: Sequence[dict], result: str, allowed: Sequence[str] | None = None) -> list[Rule]:
    """Rules of read tables: ``result`` names the outcome, ``fallback`` marks a fallback, other fields are matchers ``column:how``.

    An outcome not among ``allowed`` raises.
    """
    out = []
    for row in rows:
        if allowed is not None and row[result] not in allowed:
            raise ValueError(f"{row[result]!r} is not declared")
        when = {k: v if isinstance(v, list) else [v] for k, v in row.items() if k not in (result, "fallback", "reason") and v is not None}
        out.append(Rule(row[result], when, bool(row.get("fallback"))))
    return out
