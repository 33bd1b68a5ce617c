"""Builds are written whole or not at all."""

import pytest

from loomwright.sources import sinks


def test_build_is_gated_and_replaced(spark, tmp_path):
    folder = str(tmp_path)
    fine = spark.createDataFrame([("cross", "r", "e", "d")], "layer string, rule string, entity string, detail string")
    broken = spark.createDataFrame([("invariant", "r", "e", "d")], "layer string, rule string, entity string, detail string")
    sinks.write_build({"t": spark.range(3)}, folder, fine, {"version": "1.0.0"})
    assert spark.read.parquet(f"{folder}/t.parquet").count() == 3
    with pytest.raises(sinks.Blocked):
        sinks.write_build({"t": spark.range(9)}, folder, broken, {})
    assert spark.read.parquet(f"{folder}/t.parquet").count() == 3
    sinks.write_build({"t": spark.range(5)}, folder, fine, {"version": "1.0.1"})
    assert spark.read.parquet(f"{folder}/t.parquet").count() == 5
    assert [tuple(r) for r in spark.read.parquet(f"{folder}/meta.parquet").collect()] == [("version", "1.0.1")]
    assert len(list(tmp_path.iterdir())) == 2
    listed = sinks.manifest(spark, folder).collect()
    assert listed and all(len(r["sha256"]) == 64 and r["length"] > 0 for r in listed)
