"""Readers of literal tables: Lua data modules and block notation. Both give JSON, to be read as VARIANT."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class LiteralError(ValueError):
    """A text that is no literal table."""


_LUA = re.compile(
    r"""\s+|--\[\[.*?\]\]|--[^\n]*|(?P<num>0[xX][0-9a-fA-F]+|\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+)|(?P<str>"(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*')"""
    r"""|\[\[(?P<long>.*?)\]\]|(?P<name>[A-Za-z_][\w.]*)|(?P<op>[{}\[\]=,;()+*/-])""",
    re.S,
)


def _lua_tokens(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(text):
        found = _LUA.match(text, at)
        if not found:  # code, which is an error only where a value should be
            out.append(("other", text[at]))
            at += 1
            continue
        at = found.end()
        if found.lastgroup:
            out.append((found.lastgroup, found[found.lastgroup]))
    return out


class _Lua:
    """Values of a data module: texts, numbers with arithmetic, booleans, nil and tables. Code is an error."""

    def __init__(self, tokens: list[tuple[str, str]]) -> None:
        self.tokens, self.at = tokens, 0

    def peek(self, ahead: int = 0) -> tuple[str, str]:
        return self.tokens[self.at + ahead] if self.at + ahead < len(self.tokens) else ("end", "")

    def take(self, *wanted: str) -> bool:
        if self.peek()[1] in wanted and self.peek()[0] == "op":
            self.at += 1
            return True
        return False

    def value(self):
        kind, text = self.peek()
        if kind == "op" and text == "{":
            return self.table()
        if kind == "str":
            self.at += 1
            return _unquote(text)
        if kind == "long":
            self.at += 1
            return text
        if kind == "name" and text in ("true", "false", "nil"):
            self.at += 1
            return {"true": True, "false": False, "nil": None}[text]
        return self.sum()

    def sum(self) -> float:
        total = self.product()
        while True:
            if self.take("+"):
                total += self.product()
            elif self.take("-"):
                total -= self.product()
            else:
                return total

    def product(self) -> float:
        total = self.atom()
        while True:
            if self.take("*"):
                total *= self.atom()
            elif self.take("/"):
                divisor = self.atom()
                if not divisor:
                    raise LiteralError("division by zero")
                total /= divisor
            else:
                return total

    def atom(self) -> float:
        kind, text = self.peek()
        if self.take("-"):
            return -self.atom()
        if self.take("("):
            inner = self.sum()
            if not self.take(")"):
                raise LiteralError("unclosed bracket")
            return inner
        self.at += 1
        if kind == "num":
            return float(int(text, 16)) if text[:2].lower() == "0x" else float(text)
        if kind == "name" and text == "math.huge":
            return float("inf")
        raise LiteralError(f"{text!r} is no value")

    def table(self) -> dict:
        self.take("{")
        items, fields = [], {}
        while not self.take("}"):
            if self.peek()[0] == "end":
                raise LiteralError("unclosed table")
            if self.peek()[0] == "name" and self.peek(1) == ("op", "="):
                key = self.peek()[1]
                self.at += 2
                fields[key] = self.value()
            elif self.take("["):
                key = self.value()
                if not self.take("]") or not self.take("="):
                    raise LiteralError("broken key")
                fields[f"{key:g}" if isinstance(key, float) else str(key)] = self.value()
            else:
                items.append(self.value())
            if not self.take(",", ";") and self.peek() != ("op", "}"):
                raise LiteralError(f"{self.peek()[1]!r} in a table")
        return {"items": items, "fields": fields} if items and fields else items or fields


def _unquote(text: str) -> str:
    plain = {"n": "\n", "t": "\t", "r": "\r"}
    return re.sub(r"\\(.)", lambda m: plain.get(m[1], m[1]), text[1:-1], flags=re.S)


def lua_table(text: str, name: str | None = None):
    """The table a module returns, or the first one not empty that it assigns to ``name``."""
    tokens = _lua_tokens(text)
    empty = None
    for i, token in enumerate(tokens):
        if name is None and token == ("name", "return") or name is not None and token == ("name", name) and tokens[i + 1 : i + 2] == [("op", "=")]:
            reader = _Lua(tokens)
            reader.at = i + (1 if name is None else 2)
            if reader.peek() == ("op", "{"):
                found = reader.table()
                if found:
                    return found
                empty = found
    if empty is not None:
        return empty
    raise LiteralError(f"no table {name or 'returned'}")


def notation_block(text: str):
    """Block notation: ``key=value`` lines, blocks in braces, rows of a list one a line. Braces must pair."""
    root: dict = {}
    stack: list = [root]
    waiting: str | None = None
    for raw in text.splitlines():
        line = raw.strip().rstrip(",")
        if not line:
            continue
        top = stack[-1]
        if line == "{":
            inner: dict = {}
            _put(top, waiting, inner)
            stack.append(inner)
            waiting = None
        elif line == "}":
            if len(stack) == 1:
                raise LiteralError("a stray closing brace")
            stack.pop()
        elif line.startswith("{") and line.endswith("}"):
            row: dict = {}
            for part in line[1:-1].split(","):
                key, sign, value = part.strip().partition("=")
                if key:
                    _put(row, key.strip() if sign else None, (value if sign else key).strip())
            _put(top, waiting, row)
            waiting = None
        elif line.endswith("={"):
            inner = {}
            _put(top, line[:-2].strip(), inner)
            stack.append(inner)
        else:
            key, sign, value = line.partition("=")
            if sign and not value.strip():
                waiting = key.strip()
            else:
                _put(top, key.strip() if sign else None, (value if sign else key).strip())
    if len(stack) > 1:
        raise LiteralError("an unclosed brace")
    return root


def _put(block: dict, key: str | None, value) -> None:
    if key is None:
        block.setdefault("items", []).append(value)
    else:
        block[key] = value


def _safe(value):
    """Infinite numbers as texts, which JSON can say."""
    if isinstance(value, float) and (value != value or value in (float("inf"), float("-inf"))):
        return "inf" if value > 0 else "-inf"
    if isinstance(value, dict):
        return {k: _safe(v) for k, v in value.items()}
    return [_safe(v) for v in value] if isinstance(value, list) else value


def parsed(rows: DataFrame, text: str, kind: str, name: str | None = None) -> DataFrame:
    """``rows`` with ``value`` (VARIANT) and ``error``: one of the two is null. ``kind`` is ``lua`` or ``notation``."""

    @F.pandas_udf(T.StructType([T.StructField("json", T.StringType()), T.StructField("error", T.StringType())]))
    def read(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            try:
                out.append((json.dumps(_safe(lua_table(t or "", name) if kind == "lua" else notation_block(t or ""))), None))
            except (LiteralError, RecursionError) as x:
                out.append((None, str(x) or type(x).__name__))
        return pd.DataFrame(out, columns=["json", "error"])

    read_rows = rows.withColumn("_p", read(F.col(text)))
    return read_rows.withColumn("value", F.try_parse_json("_p.json")).withColumn("error", F.col("_p.error")).drop("_p")
