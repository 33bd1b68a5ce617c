"""What is let go of between the steps of a long pipeline."""

import gc
import time

from pyspark.sql import functions as F

from loomwright.session import release


def test_what_is_dead_is_let_go_of_though_its_handles_are_in_cycles(spark):
    files = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    release(spark)
    time.sleep(2)
    before = files()
    gc.disable()
    try:
        frame = spark.range(10_000).withColumn("k", F.col("id") % 97).repartition(7, "k")
        assert frame.count() == 10_000 and files() > before
        del frame
        release(spark)
        until = time.time() + 20
        while files() > before and time.time() < until:
            time.sleep(0.2)
        assert files() <= before
    finally:
        gc.enable()
