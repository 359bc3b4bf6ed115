"""Streams with state of their own: ids with lifetimes, files followed byte by byte."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..sources.tail import tail
from ..streaming import state
from .base import WITH
from .registry import query, table
from .source_queries import READ, place, read, records


@query(
    """WITH RECURSIVE e AS (SELECT user_id AS k, event_id, ts, CASE WHEN event_type = 'error' THEN 'gap' WHEN event_type = 'purchase' AND event_id % 20 = 0 THEN 'done' ELSE 'asked' END AS kind FROM events),
    done AS (SELECT k, min(ts) AS since FROM e WHERE kind = 'done' GROUP BY k),
    gap AS (SELECT e.k, ts FROM e LEFT JOIN done USING (k) WHERE kind = 'gap' AND (since IS NULL OR ts <= since)),
    marks AS (SELECT k, min(ts) AS ts FROM gap GROUP BY k UNION ALL SELECT m.k, min(g.ts) FROM marks m JOIN gap g ON g.k = m.k AND g.ts >= m.ts + INTERVAL 7 DAY GROUP BY m.k)
    SELECT e.k AS key, event_id AS event, kind, (since IS NOT NULL AND since < e.ts) OR EXISTS (SELECT 1 FROM marks m WHERE m.k = e.k AND m.ts < e.ts AND e.ts < m.ts + INTERVAL 7 DAY) AS known,
        count(*) FILTER (kind <> 'asked') OVER (PARTITION BY e.k ORDER BY e.ts, event_id) AS attempts
    FROM e LEFT JOIN done USING (k)"""
)
def lifetimes_told(spark, sf_dir):
    """What was known before each event: fetched keys for good, keys found missing for seven days from their first mark."""
    e = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(e.schema).parquet(f"{sf_dir}/events.parquet*")
    kind = F.when(F.col("event_type") == "error", "gap").when((F.col("event_type") == "purchase") & (F.col("event_id") % 20 == 0), "done").otherwise("asked")
    events = stream.select(F.col("user_id").alias("key"), F.col("event_id").alias("event"), F.col("ts").cast("timestamp").alias("ts"), kind.alias("kind"))
    to, progress = place(spark, "lifetimes"), place(spark, "progress")
    state.run_to_folder(state.with_lifetimes(events), to, progress).awaitTermination()
    return spark.read.parquet(to).select("key", "event", "kind", "known", "attempts")


@query(f"{WITH} SELECT {READ} FROM decisions")
def lines_tailed(spark, sf_dir):
    """All decisions, from files of lines of which half are there at the first run and all at the second; each line is read once."""
    landing, to, progress = (place(spark, x) for x in ("landing", "tailed", "progress"))
    d, half = records(spark, sf_dir), F.xxhash64("decision_id") % 2 == 0
    for now in (half, ~half):
        d.where(now).write.mode("append").json(landing)
        lines = tail(spark, landing, suffix=".json", range_bytes=1 << 20)
        state.run_to_folder(lines, to, progress).awaitTermination()
    found = spark.read.parquet(to)
    return read(found.select(F.from_json("value", schemas.DECISION).alias("d")).select("d.*"))
