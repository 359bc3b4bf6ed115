"""State by key with lifetimes: ids that are known for good, gaps that are known for a while, attempts that are counted."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

GAP_TTL = timedelta(days=7)
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries that are started within keep their state in RocksDB, which arbitrary state needs and which spills to disk."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STORE)
        else:
            spark.conf.set(STORE, before)


def micros(at) -> int:
    """Microseconds of a time, which may come with a zone or, as Spark's rows do, in the worker's own."""
    return round(at.timestamp() * 1_000_000)


class Lifetimes(StatefulProcessor):
    """Of each key: when it was fetched (never forgotten), when it was first found missing (forgotten after ``ttl``), attempts."""

    def __init__(self, ttl: timedelta):
        self.ttl = ttl // timedelta(microseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.done = handle.getValueState("done", "at long")
        self.gap = handle.getValueState("gap", "at long")
        self.tries = handle.getValueState("tries", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        done = self.done.get()[0] if self.done.exists() else None
        gap = before = self.gap.get()[0] if self.gap.exists() else None
        tries = self.tries.get()[0] if self.tries.exists() else 0
        had, tried = done, tries
        for r in sorted(rows, key=lambda r: (r["ts"], r["event"] is not None, r["event"])):
            at = micros(r["ts"])
            if gap is not None and at - gap >= self.ttl:
                gap = None
            known = done is not None or gap is not None
            if r["kind"] != "asked":
                tries += 1
            if r["kind"] == "done" and done is None:
                done = at
            elif r["kind"] == "gap" and not known:
                gap = at
            yield Row(key=key[0], event=r["event"], ts=r["ts"], kind=r["kind"], known=known, attempts=tries)
        if done != had:
            self.done.update((done,))
        if tries != tried:
            self.tries.update((tries,))
        if gap != before:
            if gap is None:
                self.gap.clear()
            else:
                self.gap.update((gap,))
                self.handle.registerTimer((gap + self.ttl) // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """The watermark has passed a gap's end: it takes no more room. A gap that was marked later stays."""
        if self.gap.exists() and (self.gap.get()[0] + self.ttl) // 1000 <= expiredTimerInfo.getExpiryTimeInMs():
            self.gap.clear()
        return iter(())

    def close(self) -> None:
        pass


def with_lifetimes(events: DataFrame, ttl: timedelta = GAP_TTL, late: str = "1 day") -> DataFrame:
    """(key, event, ts, kind, known, attempts) for each event (key, event, ts, kind) of a stream; ``event`` is its id.

    ``kind``: ``asked`` (is it to be fetched?), ``done`` (fetched) or ``gap`` (nothing there). ``known`` is what held before the event: the key
    was fetched at any time, or found missing less than ``ttl`` ago. A gap counts from its first mark. ``attempts``
    counts done and gap events so far, this one included. Equal times are ordered by event. Events that come later than
    the watermark allows are dropped, as are those without a time; a null key is a key of its own. A key's events of one
    trigger are sorted in one task; bound them by the source's rate.
    """
    kind = events.schema
    rows = events.where("ts IS NOT NULL").select("key", "event", "ts", "kind").withWatermark("ts", late)
    out = f"key {kind['key'].dataType.simpleString()}, event {kind['event'].dataType.simpleString()}, ts timestamp, kind string, known boolean, attempts long"
    return rows.groupBy("key").transformWithState(statefulProcessor=Lifetimes(ttl), outputStructType=out, outputMode="append", timeMode="EventTime")


def run_to_folder(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what a stream of events has now as Parquet, and go on from there the next time."""
    with rocksdb(df.sparkSession):
        return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def to_fetch(found: DataFrame) -> DataFrame:
    """Events that ask for a key which is not known: what is to be fetched."""
    return found.where((F.col("kind") == "asked") & ~F.col("known"))
