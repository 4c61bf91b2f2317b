"""Session settings and lineage cuts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session with the engine's settings; clusters bring their own."""
    b = SparkSession.builder.master(f"local[{cores}]").appName("vestigo")
    settings = BASE_CONF | {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.host": "127.0.0.1",
        "spark.sql.execution.sortBeforeRepartition": "false",  # one process: no task is run again on other rows
    } | conf
    spark = b.config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where it is unset, a folder of this machine if all of Spark runs on it, else an error."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
    if named:
        return named
    if sc.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), f"vestigo-{os.getuid()}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint into the shared folder."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
