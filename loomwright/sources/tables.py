"""HTML drop tables: cells by row, and the headings carried down to the rows below them."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loomwright.functions.text import label_of_rate, percent

_CELLS = "doc string, section string, row bigint, col bigint, header boolean, pad boolean, text string"


class _Tables(HTMLParser):
    """Rows of cells under the ids of the headings they stand below."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.section, self.row, self.col = "", -1, 0
        self.cell: list[str] | None = None
        self.header = self.pad = False
        self.cells: list[tuple] = []

    def handle_starttag(self, tag: str, attrs) -> None:
        named = dict(attrs)
        if tag == "h3" and named.get("id"):
            self.section, self.row = named["id"], -1
        elif tag == "tr":
            self.close()
            self.row, self.col = self.row + 1, 0
        elif tag in ("td", "th"):
            self.close()
            self.cell, self.header, self.pad = [], tag == "th", "pad" in (named.get("class") or "")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th", "tr", "table"):
            self.close()

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)

    def close(self) -> None:
        if self.cell is not None:
            self.cells.append((self.section, self.row, self.col, self.header, self.pad, " ".join("".join(self.cell).split())))
            self.col, self.cell = self.col + 1, None


def cells(documents: DataFrame, doc: str, html: str) -> DataFrame:
    """``(doc, section, row, col, header, pad, text)`` of every cell; a null or broken document gives what can be read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parser = _Tables()
                parser.feed(text or "")
                parser.close()
                rows += [(key, *c) for c in parser.cells]
            columns = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=[x.split()[0] for x in _CELLS.split(", ")])

    return documents.select(F.col(doc).cast("string"), F.col(html).cast("string")).mapInArrow(read, _CELLS)


def carried(rows: DataFrame, group: str, order: str, header, value, resets=None) -> DataFrame:
    """``rows`` with ``under``: the value of the last header row above, nothing after a reset until the next.

    Headers are counted down each group; rows of one count are one block and take its header's value.
    """
    down = W.partitionBy(*([group] if isinstance(group, str) else group)).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    marks = header if resets is None else header | resets
    blocks = rows.withColumn("_block", F.sum(marks.cast("int")).over(down))
    keys = [group] if isinstance(group, str) else list(group)
    return blocks.withColumn("under", F.max(F.when(header, value)).over(W.partitionBy(*keys, "_block"))).drop("_block")


def drop_rows(found: DataFrame, by_enemy: tuple[str, ...] = ()) -> DataFrame:
    """``(doc, section, item, place, rotation, stage, rarity, chance)`` of cells.

    A header row names the place; headers ``Rotation X`` and ``Stage ...`` hold for the rows below
    until the next of their kind or the next place. In sections ``by_enemy`` the header is the item
    and the rows are its places. Rows without a percentage are no drops.
    """
    lines = found.groupBy("doc", "section", "row").agg(
        F.bool_and("header").alias("is_header"),
        F.transform(F.array_sort(F.collect_list(F.when(~F.col("pad"), F.struct("col", "text")))), lambda x: x["text"]).alias("t"),
    )
    first = F.try_element_at("t", F.lit(1))
    rotation, stage = first.rlike("^Rotation "), first.rlike("(?i)stage|completion")
    place = F.col("is_header") & ~rotation & ~stage
    keys = ("doc", "section")
    out = carried(lines, keys, "row", place, first).withColumnRenamed("under", "head")
    out = carried(out, keys, "row", F.col("is_header") & rotation, F.regexp_replace(first, "^Rotation ", ""), place).withColumnRenamed("under", "rotation")
    out = carried(out, keys, "row", F.col("is_header") & stage, first, place | (F.col("is_header") & rotation)).withColumnRenamed("under", "stage")
    rate = F.try_element_at("t", F.lit(-1))
    drops = out.filter(~F.col("is_header") & percent(rate).isNotNull())
    inverted = F.col("section").isin(list(by_enemy)) if by_enemy else F.lit(False)
    return drops.select(
        "doc", "section", F.when(inverted, F.col("head")).otherwise(first).alias("item"), F.when(inverted, first).otherwise(F.col("head")).alias("place"),
        "rotation", "stage", label_of_rate(rate).alias("rarity"), percent(rate).alias("chance"),
    )


def relic_rows(found: DataFrame) -> DataFrame:
    """``(doc, relic, refinement, reward, rarity, chance)`` of sections whose headers read ``Name (Grade)``."""
    rows = drop_rows(found)
    graded = r"^(.+?)\s*\(([^()]+)\)$"
    return rows.filter(F.col("place").rlike(graded)).select("doc", F.regexp_extract("place", graded, 1).alias("relic"), F.lower(F.regexp_extract("place", graded, 2)).alias("refinement"), F.col("item").alias("reward"), "rarity", "chance")


def unread(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Headings below which nothing was read, and sections without any drop: both are reported, not lost."""
    rows = drop_rows(found)
    heads = found.filter("header").select("doc", "section", F.col("text").alias("place")).filter(~F.col("place").rlike("^Rotation |(?i)stage|completion")).distinct()
    return heads.join(rows.select("doc", "section", "place").distinct(), ["doc", "section", "place"], "left_anti"), found.select("doc", "section").distinct().join(rows.select("doc", "section").distinct(), ["doc", "section"], "left_anti")
