"""Coverage of sources: snapshots of what should be there, gaps, and the queue of missing decisions.

Queue rows: source_key, decision_year, decision_id, status (open, retrying, resolved, ignored),
retry_count, next_retry_at, first_seen_at, last_seen_at, last_error, resolved_at, resolution. All
updates are joins of a batch of events with the queue, so they run in ``foreachBatch`` as well as alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUEUE = "source_key string, decision_year int, decision_id string, status string, retry_count int, next_retry_at string, first_seen_at string, last_seen_at string, last_error string, resolved_at string, resolution string"
KEY = ["source_key", "decision_year", "decision_id"]


def latest_snapshots(snapshots: DataFrame) -> DataFrame:
    """The last snapshot of each source and year, the highest id of one day."""
    w = Window.partitionBy("source_key", "snapshot_year").orderBy(F.desc("snapshot_date"), F.desc("id"))
    return snapshots.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def record_snapshot(snapshots: DataFrame, new: DataFrame) -> DataFrame:
    """snapshots with new ones, which replace those of the same source, year and day; ids are made distinct in order."""
    counted = new.withColumn("expected_ids", F.array_distinct("expected_ids")).withColumn("expected_count", F.size("expected_ids"))
    key = ["source_key", "snapshot_year", "snapshot_date"]
    return snapshots.join(counted.select(*key), key, "left_anti").unionByName(counted, allowMissingColumns=True)


def expected(snapshots: DataFrame) -> DataFrame:
    """(source_key, snapshot_year, decision_id) of the latest snapshots' lists."""
    ids = F.array_distinct(F.filter(F.transform("expected_ids", lambda x: F.trim(x)), lambda x: x != ""))
    return latest_snapshots(snapshots).select("source_key", "snapshot_year", F.explode(ids).alias("decision_id"))


def gap_report(snapshots: DataFrame, decisions: DataFrame) -> DataFrame:
    """Expected, ingested and missing by source and year; snapshots without a list are compared by counts."""
    latest = latest_snapshots(snapshots).select("source_key", "snapshot_year", "snapshot_date", "expected_count", F.size(F.array_distinct(F.coalesce("expected_ids", F.array().cast("array<string>")))).alias("listed"))
    want = expected(snapshots)
    have = want.join(decisions.select("decision_id").distinct(), "decision_id", "left_semi").groupBy("source_key", "snapshot_year").agg(F.count("*").alias("found"))
    by_year = decisions.groupBy(F.col("court").alias("source_key"), F.substring("decision_date", 1, 4).try_cast("int").alias("snapshot_year")).agg(F.count("*").alias("counted"))
    out = latest.join(have, ["source_key", "snapshot_year"], "left").join(by_year, ["source_key", "snapshot_year"], "left")
    n = F.when(F.col("listed") > 0, F.greatest("expected_count", "listed")).otherwise(F.col("expected_count")).cast("long")
    got = F.when(F.col("listed") > 0, F.coalesce("found", F.lit(0))).otherwise(F.coalesce("counted", F.lit(0))).cast("long")
    return out.select(
        "source_key", "snapshot_year", "snapshot_date", n.alias("expected"), got.alias("ingested"), F.greatest(n - got, F.lit(0)).alias("missing"),
        F.when(n > 0, F.round(got / n, 4)).otherwise(1.0).alias("coverage"),
    )


def missing(snapshots: DataFrame, decisions: DataFrame) -> DataFrame:
    return expected(snapshots).join(decisions.select("decision_id"), "decision_id", "left_anti")


def existing(ids: DataFrame, decisions: DataFrame) -> DataFrame:
    return ids.join(decisions.select("decision_id"), "decision_id", "left_semi")


def _unless_ignored(new: Column, old: str) -> Column:
    return F.when(F.col("status") == "ignored", F.col(old)).otherwise(new)


def apply_failures(queue: DataFrame, failures: DataFrame, now: str, delay_days: int = 1) -> DataFrame:
    """The queue after failed fetches (key, error), one row each; several of one key in a batch count each.

    Ignored rows keep their state but for when and why they were seen last. Of several errors of a key the last one by ``failed_at``
    counts, if failures have that column; of equals the one that sorts last.
    """
    order = F.struct(*(c for c in ("failed_at", "error") if c in failures.columns))
    per = failures.groupBy(*KEY).agg(F.count("*").alias("_n"), F.substring(F.max_by("error", order), 1, 500).alias("_error"))
    both = queue.withColumn("_old", F.lit(True)).join(per, KEY, "full_outer")
    hit = F.col("_n").isNotNull()
    retry = F.date_add(F.lit(now).cast("date"), delay_days).cast("string")
    return both.select(
        *KEY,
        F.when(hit, _unless_ignored(F.lit("retrying"), "status")).otherwise(F.col("status")).alias("status"),
        F.when(hit, _unless_ignored(F.coalesce("retry_count", F.lit(0)) + F.col("_n"), "retry_count")).otherwise(F.col("retry_count")).cast("int").alias("retry_count"),
        F.when(hit, _unless_ignored(retry, "next_retry_at")).otherwise(F.col("next_retry_at")).alias("next_retry_at"),
        F.coalesce("first_seen_at", F.lit(now)).alias("first_seen_at"),
        F.when(hit, F.lit(now)).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
        F.when(hit, F.col("_error")).otherwise(F.col("last_error")).alias("last_error"),
        F.when(hit, _unless_ignored(F.lit(None).cast("string"), "resolved_at")).otherwise(F.col("resolved_at")).alias("resolved_at"),
        F.when(hit, _unless_ignored(F.lit(None).cast("string"), "resolution")).otherwise(F.col("resolution")).alias("resolution"),
    )


def apply_resolved(queue: DataFrame, done: DataFrame, now: str, resolution: str = "ingested") -> DataFrame:
    """The queue after decisions (key) have come in: open and retrying rows are resolved."""
    both = queue.join(done.select(*KEY).distinct().withColumn("_done", F.lit(True)), KEY, "left")
    hit = F.coalesce("_done", F.lit(False)) & F.col("status").isin("open", "retrying")
    return _resolved(both, hit, now, resolution).drop("_done")


def _resolved(df: DataFrame, hit: Column, now: str, resolution: str) -> DataFrame:
    new = {"status": F.lit("resolved"), "last_seen_at": F.lit(now), "last_error": F.lit(None).cast("string"), "resolved_at": F.lit(now), "resolution": F.lit(resolution)}
    return df.withColumn("_hit", hit).withColumns({c: F.when(F.col("_hit"), v).otherwise(F.col(c)) for c, v in new.items()}).drop("_hit")


def reconcile(queue: DataFrame, snapshots: DataFrame, decisions: DataFrame, now: str) -> DataFrame:
    """The queue after comparing with the latest snapshots: what is missing is open, what is not any more is resolved."""
    gone = missing(snapshots, decisions).select("source_key", F.col("snapshot_year").alias("decision_year"), "decision_id").distinct().withColumn("_missing", F.lit(True))
    seen = latest_snapshots(snapshots).where(F.size("expected_ids") > 0).select("source_key", F.col("snapshot_year").alias("decision_year"), F.lit(True).alias("_covered"))
    both = queue.join(gone, KEY, "full_outer").join(seen, ["source_key", "decision_year"], "left")
    hit = F.coalesce("_missing", F.lit(False))
    text = F.lit(None).cast("string")
    out = both.withColumn("_was", F.col("status")).select(
        *KEY, "_covered", "_missing", "_was",
        F.when(hit, F.when(F.col("status") == "ignored", "ignored").otherwise("open")).otherwise(F.col("status")).alias("status"),
        F.coalesce("retry_count", F.lit(0)).alias("retry_count"),
        F.when(hit, _unless_ignored(F.lit(now), "next_retry_at")).otherwise(F.col("next_retry_at")).alias("next_retry_at"),
        F.coalesce("first_seen_at", F.lit(now)).alias("first_seen_at"),
        F.when(hit, F.lit(now)).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
        F.when(hit, _unless_ignored(F.lit("snapshot_missing"), "last_error")).otherwise(F.col("last_error")).alias("last_error"),
        F.when(hit, _unless_ignored(text, "resolved_at")).otherwise(F.col("resolved_at")).alias("resolved_at"),
        F.when(hit, _unless_ignored(text, "resolution")).otherwise(F.col("resolution")).alias("resolution"),
    )
    done = F.coalesce("_covered", F.lit(False)) & F.col("_missing").isNull() & F.col("status").isin("open", "retrying")
    return _resolved(out, done, now, "snapshot_reconciled").drop("_covered", "_missing", "_was")


def attempts(events: DataFrame) -> DataFrame:
    """Fetch events with the number of each attempt at a decision within a run."""
    return events.withColumn("attempt", F.row_number().over(Window.partitionBy("run_id", "decision_id").orderBy("fetched_at", "event_id")))


def capture_rate(published: DataFrame, captured: DataFrame, day: str = "day", key: str = "decision_id") -> DataFrame:
    """Published and captured decisions by day."""
    hit = published.join(captured.select(key).distinct().withColumn("_hit", F.lit(1)), key, "left")
    return hit.groupBy(day).agg(F.count("*").alias("published"), F.count("_hit").alias("captured")).withColumn("rate", F.round(F.col("captured") * 100 / F.col("published"), 1))


def stale_sources(snapshots: DataFrame, today: str, days: int = 7) -> DataFrame:
    last = snapshots.groupBy("source_key").agg(F.max("snapshot_date").alias("last"))
    return last.withColumn("age", F.datediff(F.lit(today).cast("date"), F.col("last").cast("date"))).where(F.col("age") > days)


def silent_failures(runs: DataFrame) -> DataFrame:
    """Runs that report success but took under 30 seconds, found nothing and know over 1000 decisions."""
    return runs.where((F.col("status") == "success") & (F.col("new") == 0) & (F.col("known") > 1000) & (F.col("seconds") < 30))


def merged_health(daily: DataFrame, federal: DataFrame, key: str = "court") -> DataFrame:
    """Health of sources from two reports; the federal one counts where both have it."""
    names = [c for c in daily.columns if c != key]
    return daily.alias("d").join(federal.alias("f"), key, "full_outer").select(key, *(F.coalesce(F.col(f"f.{c}"), F.col(f"d.{c}")).alias(c) for c in names))
