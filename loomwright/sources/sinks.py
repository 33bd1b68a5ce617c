"""Writing a build: gated by its findings, staged beside its place and renamed into it."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.operators.quality import blocked


class Blocked(RuntimeError):
    """A finding of the first layer forbids output."""


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def replace_table(frame: DataFrame, path: str, sort: Sequence[str] = (), compression: str = "zstd") -> None:
    """Write a table beside ``path`` and move it there, so a reader sees the old one or the new one whole.

    ``sort`` orders rows within files, for files that differ only where the rows do.
    """
    spark = frame.sparkSession
    staged = f"{path}.{uuid.uuid4().hex}"
    (frame.sortWithinPartitions(*sort) if sort else frame).write.option("compression", compression).parquet(staged)
    place, system = _files(spark, path)
    source, _ = _files(spark, staged)
    system.mkdirs(place.getParent())
    old, had = _files(spark, f"{path}.{uuid.uuid4().hex}.old")[0], system.exists(place)
    if had:
        system.rename(place, old)
    if not system.rename(source, place):
        if had:
            system.rename(old, place)
        raise OSError(f"{staged} can't be moved to {path}")
    if had:
        system.delete(old, True)


def write_build(tables: Mapping[str, DataFrame], folder: str, findings: DataFrame, meta: Mapping[str, str]) -> None:
    """Write all tables of a build and its ``meta(key, value)``; nothing is written if a finding blocks."""
    if blocked(findings):
        raise Blocked("an invariant does not hold")
    spark = findings.sparkSession
    stamp = spark.createDataFrame(sorted(meta.items()), "key string, value string")
    for name, frame in {**tables, "meta": stamp.coalesce(1)}.items():
        replace_table(frame, f"{folder}/{name}.parquet")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, length, sha256)`` of the files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.replace(F.col("path"), F.lit(f"file:{folder}/"), F.lit("")).alias("path"), "length", F.sha2("content", 256).alias("sha256"))
