"""Session defaults and the shared-folder helpers that every operator uses."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoints that nothing refers to any more are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}
CLEAR_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine. A cluster brings its own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("allocata")
    settings = DEFAULTS | {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.sql.warehouse.dir": os.path.join(tempfile.gettempdir(), "allocata-warehouse"),
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared folder (spark.checkpoint.dir); set a local one only on a local master where none is named."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not shared and not sc.master.startswith("local["):
        raise ValueError("a cluster must name the shared folder for intermediate tables in spark.checkpoint.dir")
    sc.setCheckpointDir(shared or os.path.join(tempfile.gettempdir(), "allocata-checkpoints"))


def cut(df: DataFrame, clear: bool = False) -> DataFrame:
    """Materialise a stage in the shared folder and cut its lineage; it survives the loss of an executor.

    clear: the shuffle files it was made from are removed as soon as it is written, not when the driver collects its garbage.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if not clear:
        return df.checkpoint(eager=True)
    before = spark.conf.get(CLEAR_SHUFFLES, None)
    spark.conf.set(CLEAR_SHUFFLES, "true")
    try:
        # A plan of its own takes the setting; shuffles of other plans stay.
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.unset(CLEAR_SHUFFLES) if before is None else spark.conf.set(CLEAR_SHUFFLES, before)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str | Column) -> DataFrame:
    """Read one table of a data folder; only the named columns reach the scan."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df
