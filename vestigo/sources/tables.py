"""Parquet tables of one folder, read with column pruning and push-down left to Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scanned table of few, small files, handed round to all cores; larger tables stay as they are read.

    A file with one row group is one task, however many cores wait. Only for
    work that costs far more than moving the rows.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = df.sparkSession.sparkContext.defaultParallelism
    # only of a small table are the files listed
    return df.repartition(cores) if size < SPREAD_BYTES and len(df.inputFiles()) * 2 <= cores else df


#: Tables above this size have splits enough.
SPREAD_BYTES = 64 << 20


def relation_key(column: str | object) -> object:
    """Relation names compare without blanks at the ends and without case."""
    c = F.col(column) if isinstance(column, str) else column
    return F.lower(F.trim(c))
