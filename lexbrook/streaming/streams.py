"""Incremental forms of the batch operators: landing folders, rollups by day, the gap queue, windows.

Progress is kept by checkpoints of the queries. Files must not change once they have landed, so a file is
read whole or not at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from .. import schemas
from ..operators import coverage, dedup
from ..sources.readers import BAD


def landing(spark: SparkSession, path: str, schema: T.StructType = schemas.DECISION, fmt: str = "json", per_trigger: int = 1000) -> DataFrame:
    """New files of a folder; malformed JSON lines are left out."""
    if fmt != "json":
        return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", per_trigger).load(path)
    wide = T.StructType([*(T.StructField(f.name, f.dataType) for f in schema.fields), T.StructField(BAD, T.StringType())])
    df = spark.readStream.schema(wide).option("columnNameOfCorruptRecord", BAD).option("maxFilesPerTrigger", per_trigger).json(path)
    return df.where(F.col(BAD).isNull()).drop(BAD)


def ingest(stream: DataFrame, path: str, checkpoint: str, key: str = "decision_id", every: str | None = None) -> StreamingQuery:
    """Append decisions whose id is new, cleansed. Runs what has landed and stops, or goes on with a period."""

    def batch(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        rows = dedup.cleansed(df)
        try:
            known = spark.read.parquet(path).where(F.col("epoch") != epoch).select(key)
        except Exception as e:  # nothing written yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            known = None
        new = dedup.insert_or_ignore(rows, known, [key], [F.col("scraped_at")], dedup.REQUIRED)
        # a batch that is run again replaces its own partition
        new.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(path)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def daily_counts(stream: DataFrame, ts: str = "ts", late: str = "1 day") -> DataFrame:
    """Counts and sums by day and kind; a day is final once the watermark has passed it."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("day"), "event_type", "n", "total")


def sliding_counts(stream: DataFrame, ts: str = "ts", length: str = "1 hour", step: str = "15 minutes", late: str = "1 hour") -> DataFrame:
    return stream.withWatermark(ts, late).groupBy(F.window(ts, length, step).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(stream: DataFrame, key: str = "user_id", ts: str = "ts", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    return stream.withWatermark(ts, late).groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def rollup_by_day(rows: DataFrame, path: str, day: str = "day") -> None:
    """A rollup that replaces the days that it has and no others, so a late day is run again as a whole."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def run_to_memory(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a streaming query over what there is, and give its result as a table."""
    spark = df.sparkSession
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


def unseen_within(stream: DataFrame, key: str, ts: str = "ts", ttl: str = "7 days") -> DataFrame:
    """Events whose key has not come within a time: ids are state that expires with the watermark, so a key may come again later."""
    return stream.withWatermark(ts, ttl).dropDuplicatesWithinWatermark([key])


class GapQueue:
    """The queue of missing decisions, kept in versions: each batch of events commits a new one, once."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        from ..sources import sinks

        known = sinks.versions(self.spark, self.path)
        return sinks.current(self.spark, self.path) if known else self.spark.createDataFrame([], coverage.QUEUE)

    def apply(self, events: DataFrame, epoch: int, now: str) -> None:
        """Failed (error not null) and done fetches of a batch; an epoch that is committed already is not applied again."""
        from ..sources import sinks

        known = sinks.versions(self.spark, self.path)
        if any(int(v) >= epoch for _, v, _ in known):
            return
        queue = coverage.apply_failures(self.read(), events.where("error IS NOT NULL"), now)
        sinks.versioned(coverage.apply_resolved(queue, events.where("error IS NULL"), now), self.path, str(epoch), after=known[-1][0] if known else -1)

    def run(self, stream: DataFrame, checkpoint: str, now: str) -> StreamingQuery:
        return stream.writeStream.foreachBatch(lambda df, epoch: self.apply(df, epoch, now)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
