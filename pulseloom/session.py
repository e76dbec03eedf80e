"""Session settings the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that change results or are required by an operator. All are runtime
# SQL settings, so they also apply to a session somebody else has started.
REQUIRED = {
    # naive ISO strings and epoch millis are UTC
    "spark.sql.session.timeZone": "UTC",
    # a repeated JSON key keeps its last value instead of failing the record
    "spark.sql.variant.allowDuplicateKeys": "true",
    # needed by transformWithState
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a batch writes its changes of the state, not the state
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Settings that change no result.
FASTER = {
    # The JVM leaves methods of more than 8000 bytes interpreted, and the parser of a message makes
    # such a one; beyond the limit its expressions run as many small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above; partition counts stay the cluster's choice."""
    for name, value in {**REQUIRED, **FASTER}.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may leave it unset; it then gets a fresh folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def local_session(cores: int | str = "*", memory: str = "8g", partitions: int = 8,
                  **extra: str) -> SparkSession:
    """Session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("pulseloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # recording the Python line of every column doubles the time to build a plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.local.dir", os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()))
    )
    for name, value in {**REQUIRED, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
