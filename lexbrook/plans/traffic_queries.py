"""Traffic statistics over the events table, read as an access log; and its streaming form."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import status_bucket
from ..operators import traffic
from ..streaming import streams
from .registry import query, table

STATUS = "CASE event_id % 7 WHEN 0 THEN '200' WHEN 1 THEN '404' WHEN 2 THEN '429' WHEN 3 THEN '500' WHEN 4 THEN '301' WHEN 5 THEN '418' ELSE 'x' END"
LOG = f"log AS (SELECT event_id, ts, CAST(ts AS DATE) AS day, event_type AS client, 'e' || (event_id % 3) AS endpoint, {STATUS} AS status, value AS rtime_ms, event_id % 1000 AS bytes, lpad(CAST(user_id AS VARCHAR), 8, '0') AS cohort FROM events)"
BUCKET = "CASE status WHEN '200' THEN '2xx' WHEN '301' THEN '3xx' WHEN '404' THEN '404' WHEN '429' THEN '429' WHEN '418' THEN '4xx' WHEN '500' THEN '5xx' ELSE 'other' END"


def log(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "ts", F.col("ts").cast("date").alias("day"), F.col("event_type").alias("client"), F.concat(F.lit("e"), (F.col("event_id") % 3).cast("string")).alias("endpoint"), F.expr(STATUS).alias("status"),
        F.col("value").alias("rtime_ms"), (F.col("event_id") % 1000).alias("bytes"), F.lpad(F.col("user_id").cast("string"), 8, "0").alias("cohort"),
    )


@query(
    f"""WITH {LOG} SELECT day, client, endpoint, count(*) AS n, count(CASE WHEN {BUCKET} IN ('4xx', '404', '429') THEN 1 END) AS err_4xx, count(CASE WHEN {BUCKET} = '5xx' THEN 1 END) AS err_5xx, CAST(sum(bytes) AS BIGINT) AS bytes_total,
        round(quantile_cont(rtime_ms, 0.5), 6) AS p50, round(quantile_cont(rtime_ms, 0.95), 6) AS p95 FROM log GROUP BY day, client, endpoint"""
)
def traffic_rollup(spark, sf_dir):
    c = traffic.cells(traffic.without_bots(log(spark, sf_dir)), "day", "client", "endpoint")
    return c.withColumns({p: F.round(p, 6) for p in ("p50", "p95")})


@query("SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY event_type")
def percentile(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type").agg(F.round(F.percentile("value", F.lit(0.5)), 6).alias("p50"), F.round(F.percentile("value", F.lit(0.95)), 6).alias("p95"))


@query(f"WITH {LOG} SELECT client, count(DISTINCT CASE WHEN length(cohort) = 8 THEN cohort END) AS n_cohorts FROM log GROUP BY client")
def reach_exact(spark, sf_dir):
    return traffic.reach(log(spark, sf_dir))


@query()
def reach_hll(spark, sf_dir):
    return traffic.reach(log(spark, sf_dir), approximate=True)


@query(
    f"""WITH {LOG}, h AS (SELECT client, ('0x' || substring(sha256(cohort), 1, 16))::UBIGINT AS h FROM log), g AS (SELECT client, h & 4095 AS reg, h >> 12 AS rest FROM h),
    r AS (SELECT client, reg, max(CASE WHEN rest = 0 THEN 53 ELSE bit_count(xor(rest::BIGINT, rest::BIGINT - 1)) END) AS r FROM g GROUP BY 1, 2),
    s AS (SELECT client, sum(pow(2.0, -r)) AS s, count(*) AS used FROM r GROUP BY 1), e AS (SELECT client, used, (0.7213 / (1 + 1.079 / 4096)) * 4096 * 4096 / (s + (4096 - used)) AS raw FROM s)
    SELECT client, CAST(round(CASE WHEN raw <= 10240 AND used < 4096 THEN 4096.0 * ln(4096.0 / (4096 - used)) ELSE raw END) AS BIGINT) AS estimate FROM e"""
)
def hyperloglog(spark, sf_dir):
    return traffic.hyperloglog(log(spark, sf_dir), "client", "cohort")


@query(f"WITH {LOG} SELECT {BUCKET} AS bucket, count(*) AS n FROM log GROUP BY 1")
def status_histogram(spark, sf_dir):
    return traffic.status_histogram(log(spark, sf_dir))


@query(f"WITH {LOG}, c AS (SELECT day, client, status, count(*) AS n FROM log GROUP BY ALL) SELECT day, client, status, n, CASE WHEN n >= 10 THEN n END AS n_public FROM c")
def k_anon_suppress(spark, sf_dir):
    c = log(spark, sf_dir).groupBy("day", "client", "status").agg(F.count("*").alias("n"))
    return traffic.published(c, "n", noise=False)


@query()
def dp_noise(spark, sf_dir):
    c = log(spark, sf_dir).groupBy("day", "client").agg(F.count("*").alias("n"))
    return traffic.published(c, "n", "day", "client")


@query("SELECT hour, n FROM (SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 48)")
def hourly_volume(spark, sf_dir):
    return traffic.hourly(table(spark, sf_dir, "events"))


@query("WITH v AS (SELECT event_type, count(*) AS n, list_sort(list(value)) AS l FROM events GROUP BY 1) SELECT event_type, n, " + ", ".join(f"l[CAST(floor(n * {p}) AS BIGINT) + 1] AS p{round(p * 100)}" for p in (0.5, 0.95, 0.99)) + " FROM v")
def latency_by_index(spark, sf_dir):
    return traffic.latency_summary(table(spark, sf_dir, "events"), "value", "event_type")


@query(
    f"""WITH {LOG}, d AS (SELECT day, client, endpoint, count(*) AS n, quantile_cont(rtime_ms, 0.5) AS p50, quantile_cont(rtime_ms, 0.95) AS p95, count(CASE WHEN {BUCKET} IN ('4xx', '404', '429') THEN 1 END) + count(CASE WHEN {BUCKET} = '5xx' THEN 1 END) AS e FROM log GROUP BY 1, 2, 3)
    SELECT endpoint, CAST(sum(n) AS BIGINT) AS n, round(avg(p50), 6) AS p50, round(avg(p95), 6) AS p95, CAST(sum(e) AS BIGINT) AS errors, round(sum(e) / sum(n), 6) AS error_rate FROM d GROUP BY endpoint HAVING sum(n) >= 20"""
)
def latency_means(spark, sf_dir):
    m = traffic.latency_means(traffic.cells(log(spark, sf_dir), "day", "client", "endpoint"), "endpoint")
    return m.withColumns({c: F.round(c, 6) for c in ("p50", "p95", "error_rate")})


@query(
    f"""WITH {LOG}, u AS (SELECT 'client' AS dimension, client AS value FROM log UNION ALL SELECT 'status', {BUCKET} FROM log UNION ALL SELECT 'cohort', cohort FROM log), c AS (SELECT dimension, value, count(*) AS n FROM u GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY n DESC, value) AS k FROM c) SELECT dimension, value, n FROM r WHERE k <= 15"""
)
def usage_counters(spark, sf_dir):
    return traffic.usage(log(spark, sf_dir), client=F.col("client"), status=status_bucket("status"), cohort=F.col("cohort"))


@query(
    """WITH e AS (SELECT lpad(CAST(user_id AS VARCHAR), 6, '0') AS ip, CASE event_id % 4 WHEN 0 THEN '/api/search' WHEN 1 THEN '/' WHEN 2 THEN '/health' ELSE '/entscheid/' || (event_id % 5) END AS path, ts, event_id % 1000 AS size,
        CASE user_id % 3 WHEN 0 THEN 'python-requests/2' WHEN 1 THEN 'Googlebot/2.1' ELSE 'curl/8' END AS agent FROM events),
    p AS (SELECT ip, count(*) AS requests, count(CASE WHEN path = '/' THEN 1 END) AS tool_requests, count(CASE WHEN path = '/api/search' THEN 1 END) AS api_requests, count(DISTINCT path) AS paths, CAST(sum(size) AS BIGINT) AS bytes, min(agent) AS top_agent FROM e WHERE path <> '/health' GROUP BY ip)
    SELECT ip, requests, tool_requests, api_requests, paths, bytes, top_agent, CASE top_agent WHEN 'python-requests/2' THEN 'python-bot' ELSE 'unknown' END AS client FROM p WHERE requests >= 5 AND top_agent <> 'Googlebot/2.1' ORDER BY requests DESC, ip LIMIT 30"""
)
def integrators(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        F.lpad(F.col("user_id").cast("string"), 6, "0").alias("ip"), F.expr("CASE event_id % 4 WHEN 0 THEN '/api/search' WHEN 1 THEN '/' WHEN 2 THEN '/health' ELSE '/entscheid/' || (event_id % 5) END").alias("path"),
        F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % 1000).alias("size"), F.expr("CASE user_id % 3 WHEN 0 THEN 'python-requests/2' WHEN 1 THEN 'Googlebot/2.1' ELSE 'curl/8' END").alias("agent"),
    )
    return traffic.integrators(traffic.profiles(e), least=5).select("ip", "requests", "tool_requests", "api_requests", "paths", "bytes", "top_agent", "client")


@query("SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def streaming_daily(spark, sf_dir):
    stream = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*")
    got = streams.run_to_memory(streams.daily_counts(stream.withColumn("ts", F.col("ts").cast("timestamp"))), "streaming_daily_result", "complete")
    return got.select(F.col("day").cast("timestamp_ntz").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))
