"""Traffic statistics from access logs: cells, percentiles, reach, suppression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import classify_client, noisy_count, status_bucket, text
from .lineage import running

#: Classes of clients that are not counted, and when counts are published.
BOTS = ["bot_google", "bot_bing", "bot_duckduck", "bot_yandex", "bot_apple", "bot_petal", "bot_scanner", "bot_seo", "bot_other"]
K_ANONYMITY, EPSILON, LATENCY_CAP_MS = 10, 1.0, 60_000
LINE = r"^(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s*$"
COMBINED = r'^(\S+) \S+ \S+ \[([^\]]+)\] "(\S+) (\S+)[^"]*" (\d{3}) (\d+|-) "[^"]*" "([^"]*)"'
SKIPPED = ["/health", "/metrics", "/metrics/all", "/dev", "/favicon.ico"]


def parse_lines(lines: DataFrame, day: str | None = None) -> DataFrame:
    """Fields of log lines (value); lines of another form are left out. day: keep lines whose start names it."""
    rows = lines if day is None else lines.where(F.substring("value", 1, 25).contains(day))
    names = ["ts", "client", "endpoint", "method", "status", "rtime", "bytes", "cohort"]
    got = rows.where(F.col("value").rlike(LINE)).select(*(F.regexp_extract("value", LINE, i + 1).alias(n) for i, n in enumerate(names)))
    ms = F.least(F.lit(LATENCY_CAP_MS), F.bround(F.col("rtime").try_cast("double") * 1000, 0).cast("int"))
    return got.withColumn("rtime_ms", ms).withColumn("bytes", F.coalesce(F.col("bytes").try_cast("long"), F.lit(0))).where("rtime_ms IS NOT NULL")


def parse_combined(lines: DataFrame, since: str | None = None) -> DataFrame:
    """ip, time, method, path, status, size, agent of combined-format lines."""
    got = lines.where(F.col("value").rlike(COMBINED)).select(
        F.regexp_extract("value", COMBINED, 1).alias("ip"), F.try_to_timestamp(F.regexp_extract("value", COMBINED, 2), F.lit("dd/MMM/yyyy:HH:mm:ss Z")).alias("ts"),
        F.regexp_extract("value", COMBINED, 3).alias("method"), F.regexp_extract("value", COMBINED, 4).alias("path"), F.regexp_extract("value", COMBINED, 5).cast("int").alias("status"),
        F.coalesce(F.regexp_extract("value", COMBINED, 6).try_cast("long"), F.lit(0)).alias("size"), F.regexp_extract("value", COMBINED, 7).alias("agent"),
    )
    return got if since is None else got.where(F.col("ts") >= F.lit(since).cast("timestamp"))


def cells(rows: DataFrame, *keys, latency: str = "rtime_ms", status: str | None = "status", size: str | None = "bytes") -> DataFrame:
    """Counts, errors, bytes and exact interpolated percentiles of each cell."""
    aggs = [F.count("*").alias("n")]
    if status:
        bucket = status_bucket(status)
        aggs += [F.count(F.when(bucket.isin("4xx", "404", "429"), 1)).alias("err_4xx"), F.count(F.when(bucket == "5xx", 1)).alias("err_5xx")]
    if size:
        aggs.append(F.sum(size).alias("bytes_total"))
    aggs += [F.percentile(latency, F.lit(0.5)).alias("p50"), F.percentile(latency, F.lit(0.95)).alias("p95")]
    return rows.groupBy(*keys).agg(*aggs)


def without_bots(rows: DataFrame, client: str = "client") -> DataFrame:
    return rows.where(~F.coalesce(F.col(client).isin(BOTS), F.lit(False)))


def published(df: DataFrame, n: str, *key, seed: int = 7, noise: bool = True) -> DataFrame:
    """n_public: null where fewer than K_ANONYMITY stand behind a count, else the count with noise."""
    value = noisy_count(n, seed, *key, epsilon=EPSILON, k=K_ANONYMITY) if noise else F.when(F.col(n) >= K_ANONYMITY, F.col(n))
    return df.withColumn("n_public", value)


def reach(rows: DataFrame, client: str = "client", cohort: str = "cohort", approximate: bool = False) -> DataFrame:
    """Distinct cohorts of each client, exactly or by a sketch of 4096 registers."""
    valid = (text(cohort) != "-") & (F.length(text(cohort)) == 8)
    c = F.when(valid, F.col(cohort))
    n = F.hll_sketch_estimate(F.hll_sketch_agg(c, F.lit(12))) if approximate else F.countDistinct(c)
    return rows.groupBy(client).agg(n.alias("n_cohorts"))


#: Distinct cohorts of a cell are told exactly up to this number; beyond it the number itself stands for "so many or more".
EXACT_COHORTS = 50_000


def reach_told(rows: DataFrame, client: str = "client", cohort: str = "cohort", most: int = EXACT_COHORTS) -> DataFrame:
    """The exact reach of each client as it is published: counted in full, told up to a number, with a mark beyond it."""
    n = F.col("n_cohorts")
    return reach(rows, client, cohort).select(client, F.least(n, F.lit(most)).alias("n_cohorts"), (n > most).alias("more"))


def highest_reach(daily: DataFrame, client: str = "client", n: str = "n_cohorts") -> DataFrame:
    """The highest daily reach of each client."""
    return daily.groupBy(client).agg(F.max(n).alias("reach"))


def all_clients(*frames: DataFrame) -> DataFrame:
    """(client) that any of several tables has."""
    out = frames[0].select("client")
    for f in frames[1:]:
        out = out.unionByName(f.select("client"))
    return out.distinct()


def usage_totals(rows: DataFrame, windows: dict[str, Column]) -> DataFrame:
    """(period, n): the rows within each of several conditions, in one pass."""
    counts = rows.agg(*(F.count(F.when(c, 1)).alias(k) for k, c in windows.items()))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(k).alias("period"), F.col(k).alias("n")) for k in windows))).alias("x")).select("x.*")


def rates(rows: DataFrame, *keys, ok: Column, empty: Column) -> DataFrame:
    """Calls by key, and which shares of them went well or came back empty, in per cent."""
    share = lambda c: F.round(100 * F.count(F.when(c, 1)) / F.count("*"), 2)
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), share(ok).alias("ok_pct"), share(empty).alias("empty_pct"))


def feature_usage(rows: DataFrame, today: str, feature: str = "feature", ts: str = "used_at") -> DataFrame:
    """Uses of each feature today and ever."""
    day = F.col(ts).cast("string").startswith(today)
    return rows.groupBy(feature).agg(F.count(F.when(day, 1)).alias("today"), F.count("*").alias("ever"))


def last_uses(rows: DataFrame, n: int = 10, ts: str = "used_at", id_col: str = "id") -> DataFrame:
    return rows.orderBy(F.desc(ts), F.desc(id_col)).limit(n)


def status_histogram(rows: DataFrame, status: str = "status") -> DataFrame:
    return rows.groupBy(status_bucket(status).alias("bucket")).agg(F.count("*").alias("n"))


def hourly(rows: DataFrame, ts: str = "ts", last: int = 48) -> DataFrame:
    """Counts of the last hours that have any."""
    h = rows.groupBy(F.date_trunc("hour", ts).alias("hour")).agg(F.count("*").alias("n"))
    return h.orderBy(F.desc("hour")).limit(last).orderBy("hour")


def latency_summary(rows: DataFrame, value: str, *keys, shares=(0.5, 0.95, 0.99)) -> DataFrame:
    """Percentiles by index, by counting instead of collecting: places come from a running count of equal values over all keys in
    order, dealt out by ranges, so a key with very many values is counted by many tasks."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("c"))
    upto = running(counts, "_upto", "c", *(F.col(k) for k in keys), F.col(value))
    starts = upto.groupBy(*keys).agg(F.min(F.col("_upto") - F.col("c")).alias("_start"), F.sum("c").alias("n"))
    same = [F.col(f"u.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    placed = upto.alias("u").join(starts.alias("s"), same or None).select(*(F.col(f"u.{k}") for k in keys), f"u.{value}", "n", (F.col("_upto") - F.col("_start")).alias("upto"))
    aggs = [F.min(F.when(F.col("upto") > F.floor(F.col("n") * p), F.col(value))).alias(f"p{round(p * 100)}") for p in shares]
    return placed.groupBy(*keys).agg(F.max("n").alias("n"), *aggs)


def profiles(rows: DataFrame) -> DataFrame:
    """What each address did: counts by kind of path, first and last time, main agent, paths, bytes."""
    used = rows.where(~F.arrays_overlap(F.array(*(F.when(F.col("path").startswith(p), F.lit(p)).otherwise("") for p in SKIPPED)), F.array(*map(F.lit, SKIPPED))))
    agents = used.groupBy("ip", "agent").agg(F.count("*").alias("c")).groupBy("ip").agg(F.max_by("agent", F.struct("c", "agent")).alias("top_agent"))
    out = used.groupBy("ip").agg(
        F.count("*").alias("requests"), F.count(F.when(F.col("path").rlike("^/(sse|messages/|$)"), 1)).alias("tool_requests"), F.count(F.when(F.col("path").rlike("^/api/"), 1)).alias("api_requests"),
        F.countDistinct("path").alias("paths"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.sum("size").alias("bytes"),
    )
    hours = F.round((F.unix_micros("last_seen") - F.unix_micros("first_seen")) / 3.6e9, 1)
    return out.withColumn("hours", hours).join(agents, "ip").withColumn("client", classify_client("top_agent"))


def integrators(p: DataFrame, least: int = 10, most: int = 30) -> DataFrame:
    return p.where((F.col("requests") >= least) & ~F.col("client").isin("googlebot", "bingbot")).orderBy(F.desc("requests"), "ip").limit(most)


def latency_means(daily: DataFrame, *keys, least: int = 20) -> DataFrame:
    """Mean daily percentiles and the error rate of what has enough calls."""
    out = daily.groupBy(*keys).agg(F.sum("n").alias("n"), F.avg("p50").alias("p50"), F.avg("p95").alias("p95"), F.sum(F.col("err_4xx") + F.col("err_5xx")).alias("errors"))
    return out.where(F.col("n") >= least).withColumn("error_rate", F.col("errors") / F.col("n"))


def usage(rows: DataFrame, k: int = 15, **dimensions: Column) -> DataFrame:
    """(dimension, value, n): the top values of several dimensions in one pass."""
    items = F.array(*(F.struct(F.lit(d).alias("dimension"), c.cast("string").alias("value")) for d, c in dimensions.items()))
    counts = rows.select(F.explode(items).alias("x")).groupBy("x.dimension", "x.value").agg(F.count("*").alias("n"))
    w = Window.partitionBy("dimension").orderBy(F.desc("n"), "value")
    return counts.withColumn("k", F.row_number().over(w)).where(F.col("k") <= k).drop("k")


def hyperloglog(rows: DataFrame, key: str, value: str, p: int = 12) -> DataFrame:
    """Distinct values by a sketch written out in expressions: registers by the low bits of SHA-256, ranks by
    the zeros behind them, linear counting where many registers are empty."""
    m = 1 << p
    h = F.conv(F.substring(F.sha2(F.col(value).cast("string"), 256), 1, 16), 16, -10).cast("long")
    rest = F.shiftrightunsigned(h, p)
    # zeros at the low end, plus one; a rest of zero counts all its bits
    low = F.when(rest == 0, 64 - p + 1).otherwise(F.bit_count(rest.bitwiseXOR(rest - 1)))
    regs = rows.where(F.col(value).isNotNull()).groupBy(key, h.bitwiseAND(m - 1).alias("register")).agg(F.max(low).alias("r"))
    s = regs.groupBy(key).agg(F.sum(F.pow(F.lit(2.0), -F.col("r"))).alias("s"), F.count("*").alias("used"))
    raw = (0.7213 / (1 + 1.079 / m)) * m * m / (F.col("s") + (m - F.col("used")))
    small = F.lit(float(m)) * F.log(F.lit(float(m)) / (m - F.col("used")))
    return s.select(key, F.round(F.when((raw <= 2.5 * m) & (F.col("used") < m), small).otherwise(raw)).cast("long").alias("estimate"))
