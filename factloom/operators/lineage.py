"""Lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary one in local mode only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            where = tempfile.mkdtemp(prefix="factloom-")
        sc.setCheckpointDir(where)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """A stage that several others read, written once to the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``cut`` as a Parquet table, for loops of joins: its estimated size is that of its files, where a checkpoint keeps the
    product of all sizes joined before it."""
    folder = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


#: Parts of a large shuffle at least.
PARTS = 200


def spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows dealt by keys over all shuffle partitions. A shuffle that Spark plans itself is merged into about as many parts as
    there are cores, each of which then holds its share of the whole table for the sorts behind it."""
    return df.repartition(max(PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)
