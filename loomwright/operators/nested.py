"""Deeply nested records as related flat tables.

A tree automaton reads every JSON value from its leaves up. The state of a value follows from its
kind and from the states of what it holds, whatever surrounds it, so one record may wrap a thing
another holds bare. What a state accepts goes to the typed table of that state; rows keep the record
and the row above them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names that one field goes by.
ITEM_KEYS = ("ItemType", "item")
COUNT_KEYS = ("ItemCount", "count")
#: The states that a table is made of.
TYPES = ("listing", "recipe", "ingredient", "icon", "name")

#: The type of the row that stands for a body that can't be read.
UNREAD = "unread"

_SCHEMA = "raw_id bigint, node bigint, above bigint, type string, variant string, position string, child_key string, val string, amount string"


def _decoded(value: str):
    """A text that is itself JSON of an object or list, else None."""
    if value[:1] in "[{":
        try:
            return json.loads(value)
        except (ValueError, RecursionError):
            return None
    return None


class Automaton:
    """Bottom-up states of the values of one body; ``states`` has them by identity, as ``id(value)``."""

    def __init__(self, body) -> None:
        self.states: dict[int, str] = {}
        self.kept: list = []  # decoded texts, which must outlive their ids
        self.texts: dict[tuple[int, str], object] = {}
        order, stack = [], [body]
        while stack:  # parents before children; read backwards, children before parents
            value = stack.pop()
            order.append(value)
            if isinstance(value, dict):
                for key, child in value.items():
                    if isinstance(child, str) and (inner := _decoded(child)) is not None:
                        self.texts[id(value), key] = inner
                        self.kept.append(inner)
                        child = inner
                    if isinstance(child, (dict, list)):
                        stack.append(child)
            elif isinstance(value, list):
                stack += [x for x in value if isinstance(x, (dict, list))]
        for value in reversed(order):
            self.states[id(value)] = self._step(value)

    def get(self, value: dict, key: str):
        """A field's value, decoded if it came as text."""
        return self.texts.get((id(value), key), value.get(key))

    def state(self, value) -> str:
        if value is None or value == "":
            return "nothing"
        if isinstance(value, str):
            return "text"
        if isinstance(value, bool):
            return "flag"
        if isinstance(value, (int, float)):
            return "number"
        return self.states[id(value)]

    def _step(self, value) -> str:
        """The transition of an object or list, by the states of its children."""
        if isinstance(value, list):
            inner = sorted({self.state(x) for x in value} - {"nothing"})
            return f"list({'|'.join(inner)})"
        if not isinstance(value, dict):
            return self.state(value)
        of = {key: self.state(self.get(value, key)) for key in value}
        if any(key in of for key in ITEM_KEYS):
            return "ingredient"
        if "ingredients" in of:
            return "recipe"
        if {"slug", "gameRef", "icons", "i18n", "names", "ru_name"} & of.keys():
            return "listing"
        if "lang" in of and "path" in of:
            return "icon"
        if "lang" in of and "name" in of:
            return "name"
        if set(of) <= {"icon", "name"}:
            return "local"  # what one language says of a thing
        if of and set(of.values()) <= {"local"}:
            return "locals"
        if of and set(of.values()) <= {"text", "nothing"}:
            return "texts"
        return "object"

    def variant(self, value: dict) -> str:
        """The shape of an object: its fields with their states."""
        return ",".join(f"{key}:{self.state(self.get(value, key))}" for key in sorted(value))


class Reader:
    """Routes what the automaton accepts to typed rows of one record."""

    def __init__(self, raw: int) -> None:
        self.raw, self.rows = raw, []

    def row(self, above, kind: str, variant: str = "", position: str | None = None, key: str | None = None, val: str | None = None, amount=None) -> int:
        node = len(self.rows)
        self.rows.append((self.raw, node, above, kind, variant, position, key, val, None if amount is None else str(amount)))
        return node

    def read(self, body) -> None:
        auto = Automaton(body)
        # (value, row above, positions so far, whether the recipes of a list are numbered)
        stack: list[tuple] = [(body, None, ())]
        while stack:
            value, above, at = stack.pop()
            if isinstance(value, list):
                many = len(value) > 1
                stack += [(x, above, (*at, i) if many else at) for i, x in reversed(list(enumerate(value))) if isinstance(x, (dict, list))]
                continue
            if not isinstance(value, dict):
                continue
            state = auto.state(value)
            if state == "listing":
                self.listing(auto, value, above)
            elif state == "recipe":
                node = self.row(above, "recipe", auto.variant(value), ".".join(map(str, at)), val=self.text(value.get("result")))
                stack += self.ingredients(auto, auto.get(value, "ingredients"), node, at)
            elif state == "ingredient":
                stack += self.ingredients(auto, value, above, at)
            else:
                stack += [(x, above, at) for key in reversed(list(value)) if isinstance(x := auto.get(value, key), (dict, list))]

    @staticmethod
    def text(value) -> str | None:
        return value if isinstance(value, str) and value.strip() else None

    def ingredients(self, auto: Automaton, value, above: int, at: tuple) -> list[tuple]:
        """Rows of the ingredients; returns the recipes among them, to be read in their turn."""
        more = []
        for i, one in enumerate(value if isinstance(value, list) else [value]):
            place = (*at, i)
            if isinstance(one, list):
                more += self.ingredients(auto, one, above, place)
                continue
            if isinstance(one, str) and one.strip():
                self.row(above, "ingredient", "text", ".".join(map(str, place)), val=one)
                continue
            if not isinstance(one, dict):
                continue
            path = next((x for key in ITEM_KEYS if (x := self.text(one.get(key)))), None)
            amount = next((one[key] for key in COUNT_KEYS if one.get(key) is not None), None)
            node = self.row(above, "ingredient", auto.variant(one), ".".join(map(str, place)), val=path, amount=amount)
            more += [(x, node, place) for key in one if isinstance(x := auto.get(one, key), dict)]
        return more

    def listing(self, auto: Automaton, value: dict, above) -> None:
        node = self.row(above, "listing", auto.variant(value), val=self.text(value.get("slug")))
        icons, names, local = (auto.get(value, key) for key in ("icons", "names", "i18n"))
        pairs = list(icons.items()) if isinstance(icons, dict) else [(x.get("lang"), x.get("path")) for x in icons if isinstance(x, dict)] if isinstance(icons, list) else []
        named = [(key[:-5], value[key]) for key in ("en_name", "ru_name") if key in value]
        named += list(names.items()) if isinstance(names, dict) else [(x.get("lang"), x.get("name")) for x in names if isinstance(x, dict)] if isinstance(names, list) else []
        for lang, x in local.items() if isinstance(local, dict) else ():
            if isinstance(x, dict):
                pairs.append((lang, x.get("icon")))
                named.append((lang, x.get("name")))
        for lang, path in dict.fromkeys((lang, path) for lang, path in pairs if isinstance(lang, str) and isinstance(path, str)):
            if self.text(lang) and self.text(path):
                self.row(node, "icon", key=lang, val=path)
        for lang, name in dict.fromkeys((lang, name) for lang, name in named if isinstance(lang, str) and isinstance(name, str)):
            if self.text(lang) and self.text(name):
                self.row(node, "name", key=lang, val=name)


def _flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    schema = pa.schema(list(zip(names, [pa.int64()] * 3 + [pa.string()] * 6)))
    for batch in batches:
        rows: list[tuple] = []
        for raw, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            reader = Reader(raw)
            try:
                reader.read(json.loads(body))
            except (ValueError, TypeError, RecursionError) as error:
                # a body that can't be read, or not to its end, is told of and gives nothing else
                reader.rows.clear()
                if body is not None and body.strip():
                    reader.row(None, UNREAD, type(error).__name__)
            rows += reader.rows
        for first in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[first : first + 10_000]), schema.types)], schema=schema)


def flatten(records: DataFrame, key: str, body: str) -> DataFrame:
    """All rows of all typed tables in one long form.

    ``(raw_id, node, above, type, variant, position, child_key, val, amount)``: ``node`` numbers the
    rows of a record, ``above`` is the row it belongs to, ``variant`` the shape it was read from. A
    body that is no JSON, or nested beyond what the JSON reader takes, gives one row of type ``unread``
    with the error as its variant; one that is null or blank gives no rows, and neither does a null or blank value of an icon, a name or a text ingredient; an ingredient without an item
    keeps its row with a null ``val``, since recipes may hang from it. Repeated records keep their rows.
    """
    return records.select(F.col(key).cast("bigint").alias("raw_id"), F.col(body).cast("string").alias("body")).mapInArrow(_flatten, _SCHEMA)


def subtype(rows: DataFrame, kind: str) -> DataFrame:
    """The typed table of one kind: the common keys and its own columns under their names."""
    own = {
        "listing": {"val": "slug"},
        "recipe": {"position": "position", "val": "result"},
        "ingredient": {"position": "position", "val": "item", "amount": "amount"},
        "icon": {"child_key": "lang", "val": "path"},
        "name": {"child_key": "lang", "val": "name"},
    }[kind]
    return rows.filter(F.col("type") == kind).select("raw_id", "node", "above", "variant", *[F.col(a).alias(b) for a, b in own.items()])
