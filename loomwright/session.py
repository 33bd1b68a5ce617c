"""Session, table and lineage helpers shared by every operator."""

from __future__ import annotations

import atexit
import gc
import os
import re
import shutil
import tempfile

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

#: Settings for a local run; on a cluster the submitter's settings hold.
LOCAL = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local(cores: int | str = 8, partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A session on this machine with the settings that tests and bench share."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("loomwright")
    for key, value in (LOCAL | {"spark.sql.shuffle.partitions": str(partitions), "spark.driver.memory": memory}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table, a file or a folder of files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that executors share, as the session names it. Only a local master, as in tests, may go without: it gets a temporary one."""
    context = spark.sparkContext
    found = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="loomwright-checkpoint-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(found)
    return found


def cut(frame: DataFrame) -> DataFrame:
    """Write ``frame`` to the shared checkpoint folder and read on from there, so no executor loss can undo it."""
    checkpoint_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let go of shuffles, broadcasts and checkpoints that no frame refers to any more.

    They are dropped when the driver's collector finds their handles dead, which a driver with room
    to spare may put off for as long as many steps pile them up; so long pipelines ask for it between steps.
    Python's handles of them are in cycles, so Python's collector goes first.
    """
    gc.collect()
    jvm = spark.sparkContext._jvm
    if jvm is not None:
        jvm.System.gc()
        trim(spark)


def trim(spark: SparkSession) -> None:
    """Give back to the machine what the driver's native heap has free, if its Java has the command for it.

    Planning and compiling many queries in many threads leaves the C library with hundreds of MB that nothing uses.
    """
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    try:
        # the server's own class is not open to callers, its interface is
        called = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        said = gateway.new_array(jvm.java.lang.Object, 4)
        said[0], said[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        called.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), said)
    except Py4JError:
        pass  # another Java, or another C library


def reach(spark: SparkSession) -> SparkSession:
    """``spark``, whose Python workers find this package where the driver does, whatever folder they start in."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *[p for p in known if p]])
    return spark
