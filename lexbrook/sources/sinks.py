"""Writers. Existing rows are merged by key before files are replaced; replacing is one rename or one commit."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup
from ..operators.lineage import checkpointed


def export(df: DataFrame, path: str, by: str = "court") -> None:
    """Zstandard Parquet by court; courts that are gone lose their files, since all of it is replaced. A court with very many rows is
    written by several tasks, as Spark splits it by its size."""
    df.hint("rebalance", F.col(by)).write.mode("overwrite").partitionBy(by).option("compression", "zstd").parquet(path)


def upsert_partitions(df: DataFrame, path: str, key: list[str], by: str) -> None:
    """Rows merged into the partitions that they belong to; other partitions are not touched."""
    spark = df.sparkSession
    try:
        old = spark.read.parquet(path)
    except Exception as e:  # nothing written yet
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        old = None
    rows = df if old is None else dedup.upsert_replace(old.join(df.select(by).distinct(), by, "left_semi"), df, key)
    # the old rows are read from where the new ones go, so they are fixed first
    rows = checkpointed(rows) if old is not None else rows
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).option("compression", "zstd").parquet(path)


def daily_shard(df: DataFrame, path: str, day: str) -> None:
    """A day's decisions; rows of the same id and day are replaced."""
    upsert_partitions(df.withColumn("day", F.lit(day)), path, ["decision_id"], "day")


def compact_months(spark: SparkSession, daily: str, path: str) -> None:
    """Daily partitions in one file a month, or in a few if the month is larger than what a task should write."""
    df = spark.read.parquet(daily).withColumn("month", F.substring(F.col("day").cast("string"), 1, 7))
    df.hint("rebalance", F.col("month")).write.mode("overwrite").partitionBy("month").option("compression", "zstd").parquet(path)


def append_new(df: DataFrame, path: str, key: list[str], order=(), required: list[str] = ()) -> None:
    """Rows whose key is not there yet, the first of each key."""
    spark = df.sparkSession
    try:
        existing = spark.read.parquet(path).select(*key)
    except Exception as e:  # nothing written yet
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        existing = None
    dedup.insert_or_ignore(df, existing, key, list(order) or [F.lit(1)], list(required)).write.mode("append").parquet(path)


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, path: str) -> list[tuple[int, str, str]]:
    """(number, version, place) of all committed versions, the last one at the end."""
    fs, folder = _files(spark, f"{path}/_commits")
    if not fs.exists(folder):
        return []
    names = sorted(f.getPath().getName() for f in fs.listStatus(folder))
    return [(int(n), v, f"{path}/v={v}~{u}") for n, v, u in (x.split("~") for x in names if x.count("~") == 2)]


class CommitConflict(RuntimeError):
    """Another writer has committed after what this one had read."""


def claimed(spark: SparkSession, path: str, number: int) -> bool:
    """Whether this writer gets a number: the one that creates the number's file, as creating fails if it is there."""
    fs, name = _files(spark, f"{path}/_numbers/{number:020d}")
    try:
        fs.create(name, False).close()
    except Exception as e:
        if "AlreadyExists" not in str(e) and not fs.exists(name):
            raise
        return False
    return True


def versioned(df: DataFrame, path: str, version: str, after: int | None = None) -> str:
    """Write a rebuilt table beside the old ones and commit it by creating one empty file, whose name says all, so there is no moment
    at which no version or half a version counts. A place is never written twice. Returns the place.

    A number is claimed by one writer only. ``after``: the number of the version that df was made from (-1: none was there); if another
    writer has claimed the next one meanwhile, CommitConflict is raised and nothing is hidden. Without it the next
    free number is taken, so the last to commit counts.
    """
    spark = df.sparkSession
    if "~" in version or "/" in version:
        raise ValueError("a version is named without ~ and /")
    unique = uuid.uuid4().hex
    place = f"{path}/v={version}~{unique}"
    df.write.parquet(place)
    number = max((n for n, _, _ in versions(spark, path)), default=-1) + 1 if after is None else after + 1
    while not claimed(spark, path, number):
        if after is not None:
            raise CommitConflict(f"version {number} of {path} is another writer's")
        number += 1
    fs, commit = _files(spark, f"{path}/_commits/{number:020d}~{version}~{unique}")
    fs.create(commit, False).close()
    return place


def current(spark: SparkSession, path: str) -> DataFrame:
    """The version committed last."""
    if not (known := versions(spark, path)):
        raise FileNotFoundError(f"no version is committed in {path}")
    return spark.read.parquet(known[-1][2])


def event_log(df: DataFrame, path: str) -> None:
    """Append events; a write is one job, whose files count together or not at all, and readers ignore what is not committed."""
    df.write.mode("append").parquet(path)
