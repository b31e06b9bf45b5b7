"""Cutting long lineages: written tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession

from folia.session import scratch


def materialize(df: DataFrame) -> DataFrame:
    """Write under spark.checkpoint.dir and read back."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that a task gets of a table that is dealt by keys.
ROWS = 250_000


def dealt(df: DataFrame, rows: int, *keys: str | Column) -> DataFrame:
    """df by keys over as many tasks as `rows` needs, so that the memory of a task does not grow with the table; left as it is where Spark's own number of partitions is enough."""
    n = -(-rows // ROWS)
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def scattered(df: DataFrame, rows: int, *keys: str | Column) -> DataFrame:
    """df by keys over as many tasks as `rows` needs, one for each core at least. As dealt, but also where Spark's own number of partitions would be enough: for steps that make many more rows
    than they read, since scans follow the size of files and adaptive execution joins partitions by their bytes."""
    return df.repartition(max(-(-rows // ROWS), df.sparkSession.sparkContext.defaultParallelism), *keys)


#: The setting for bytes of files that a task reads, Spark's default, and what stands in its place while short_splits holds.
SPLIT = ("spark.sql.files.maxPartitionBytes", "134217728b", "16m")


@contextmanager
def short_splits(spark: SparkSession) -> Iterator[None]:
    """Tasks that start inside read short pieces of files, so that what they hold for a shuffle does not grow with the table. Another setting than Spark's default stays."""
    key, usual, short = SPLIT
    if spark.conf.get(key) != usual:
        yield
        return
    spark.conf.set(key, short)
    try:
        yield
    finally:
        spark.conf.set(key, usual)
