"""JSON manifests: every object of every top-level list, and typed projections of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions.text import clean_json


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """``(path, body)`` of whole text files."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("body"))


def objects(bodies: DataFrame, body: str = "body") -> DataFrame:
    """``(..., array_name, pos, obj)``: the objects of all top-level lists, tagged with the list's name.

    Control bytes become blanks before parsing. A body that is no JSON object gives no rows.
    """
    parsed = bodies.withColumn("_v", F.try_parse_json(clean_json(F.col(body)))).drop(body)
    parsed.createOrReplaceTempView("_manifest_bodies")
    spark = bodies.sparkSession
    kept = ", ".join(f"b.`{c}`" for c in parsed.columns if c != "_v")
    prefix = kept + ", " if kept else ""
    return spark.sql(
        f"select {prefix}o.key as array_name, i.pos, i.value as obj from _manifest_bodies b, lateral variant_explode(b._v) as o, lateral variant_explode(o.value) as i "
        "where b._v is not null and o.key is not null and i.key is null"
    )


def field(path: str, kind: str = "string", obj: str = "obj") -> Column:
    """A field of a variant, null where it is missing, of another kind or an empty text."""
    found = F.try_variant_get(F.col(obj), f"$.{path}", kind)
    return F.nullif(found, F.lit("")) if kind == "string" else found


def project(rows: DataFrame, required: Mapping[str, str], optional: Mapping[str, tuple[str, str]], defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Typed columns of objects: rows without a required text are left out, optional fields may be null or take a default."""
    defaults = defaults or {}
    columns = [field(path).alias(name) for name, path in required.items()]
    for name, (path, kind) in optional.items():
        value = field(path, kind)
        columns.append((F.coalesce(value, defaults[name]) if name in defaults else value).alias(name))
    kept = rows.select(*[c for c in rows.columns if c != "obj"], *columns)
    for name in required:
        kept = kept.filter(F.col(name).isNotNull())
    return kept


def summed_parts(rows: DataFrame, key: str, parts: str, item: str, count: str) -> DataFrame:
    """``(key, item, qty, pos)``: repeated parts of one list summed, in the order of their first; counts below 1 are 1."""
    unrolled = rows.select(key, F.posexplode(parts).alias("pos", "part"))
    qty = F.when(F.col(f"part.{count}") > 0, F.col(f"part.{count}")).otherwise(1)
    return unrolled.filter(F.col(f"part.{item}").isNotNull()).groupBy(key, F.col(f"part.{item}").alias(item)).agg(F.sum(qty).alias("qty"), F.min("pos").alias("pos"))


def zipped_nonzero(rows: DataFrame, key: str, values: str, names: Sequence[str]) -> DataFrame:
    """``(key, name, value)`` of a list paired with names by place, without zeros and what has no name."""
    return rows.select(key, F.posexplode(values).alias("at", "value")).filter((F.col("value") != 0) & (F.col("at") < len(names))).select(key, F.try_element_at(F.array(*[F.lit(n) for n in names]), F.col("at") + 1).alias("name"), "value")


def last_element(values: Column) -> Column:
    """The last of a list, null if it is empty."""
    return F.try_element_at(values, F.lit(-1))


def index_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """``(name, lang, hash)`` of index lines ``name_lang.json!hash``; lines without a mark are left out."""
    parts = F.split(F.col(line), "!")
    name = parts[0]
    return lines.filter(F.size(parts) >= 2).select(F.regexp_replace(F.regexp_replace(name, r"\.json$", ""), r"_[a-z]{2}$", "").alias("name"), F.nullif(F.regexp_extract(name, r"_([a-z]{2})(?:\.json)?$", 1), F.lit("")).alias("lang"), parts[1].alias("hash"))
