"""Cutting the lineage of tables that loops build up, and folders that all machines share."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Only where none is named and all runs in one
    process (tests, a laptop) is it a local one."""
    sc = spark.sparkContext
    given = sc._jsc.sc().getCheckpointDir()
    if given.isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="ckpt"))
        given = sc._jsc.sc().getCheckpointDir()
    return given.get()


def checkpointed(df: DataFrame) -> DataFrame:
    """A copy in the shared folder, which survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


_STORED: dict[tuple, str] = {}


def stored(spark: SparkSession, name: str, make) -> DataFrame:
    """A table of the shared folder under a name; made from make() when it is asked for first in this application."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _STORED:
        path = f"{shared_folder(spark)}/table-{abs(hash(key)):x}"
        make().write.mode("overwrite").parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """df with a number from 1 in the order given, without bringing all rows into one task: rows are dealt out by ranges,
    numbered there and counted. Only the counts, one a range, are collected; how many rows lie before a range is broadcast."""
    dealt = checkpointed(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    starts, at = [], 0
    for r in sorted(dealt.groupBy("_part").agg(F.count("*").alias("n")).collect()):
        starts.append((r["_part"], at))
        at += r["n"]
    starts = df.sparkSession.createDataFrame(starts, "_part int, _before long")
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return dealt.withColumn(name, own).join(F.broadcast(starts), "_part").withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_before")


def running(df: DataFrame, name: str, value: str, *order: Column) -> DataFrame:
    """df with the sum of ``value`` over all rows up to each one, in an order without ties; dealt out as ``numbered`` does, by ranges
    whose sums alone are collected."""
    dealt = checkpointed(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    starts, at = [], 0
    for r in sorted(dealt.groupBy("_part").agg(F.sum(value).alias("n")).collect()):
        starts.append((r["_part"], at))
        at += r["n"] or 0
    starts = df.sparkSession.createDataFrame(starts, "_part int, _before long")
    own = F.sum(value).over(Window.partitionBy("_part").orderBy(*order))
    return dealt.withColumn(name, own).join(F.broadcast(starts), "_part").withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_before")
