"""Joins, windows, limits, coverage and evaluation over the relational tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import coverage, evaluate
from .base import WITH, decisions
from .registry import query, table


@query("SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC NULLS LAST, l_linenumber) AS candidate_rank, count(*) OVER (PARTITION BY l_orderkey) AS candidate_count FROM lineitem")
def candidate_rank_count(spark, sf_dir):
    w = Window.partitionBy("l_orderkey")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.row_number().over(w.orderBy(F.col("l_shipdate").desc_nulls_last(), "l_linenumber")).cast("long").alias("candidate_rank"), F.count("*").over(w).alias("candidate_count")
    )


@query("SELECT o_custkey AS source_key, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS id FROM orders GROUP BY o_custkey")
def latest_snapshot(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("source_key"), F.lit(1).alias("snapshot_year"), F.col("o_orderdate").alias("snapshot_date"), F.col("o_orderkey").alias("id"))
    return coverage.latest_snapshots(o).select("source_key", "id")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 7 = 0)")
def anti_missing(spark, sf_dir):
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders").where("o_orderkey % 7 = 0").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def semi_existing(spark, sf_dir):
    big = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").join(big, "o_orderkey", "left_semi").select("o_orderkey")


@query("SELECT c_mktsegment, n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2")
def joined_totals(spark, sf_dir):
    j = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    return j.groupBy("c_mktsegment", "n_name").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT court, coalesce(f, d) AS n FROM (SELECT c_mktsegment AS court, count(*) AS d FROM customer WHERE c_custkey % 2 = 0 GROUP BY 1) FULL JOIN (SELECT c_mktsegment AS court, count(*) AS f FROM customer WHERE c_custkey % 6 = 1 GROUP BY 1) USING (court)")
def merged_health(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "court")
    return coverage.merged_health(c.where("c_custkey % 2 = 0").groupBy("court").agg(F.count("*").alias("n")), c.where("c_custkey % 6 = 1").groupBy("court").agg(F.count("*").alias("n")))


SNAPSHOTS = """s AS (SELECT source AS source_key, CAST(2000 + doc_id % 3 AS INT) AS snapshot_year, doc_id, max(CASE WHEN doc_id % 2 = 0 AND doc_id % 3 <> 1 THEN 1 ELSE 0 END) OVER (PARTITION BY source, doc_id % 3) AS later FROM documents),
latest AS (SELECT source_key, snapshot_year, CASE WHEN later = 0 THEN '2024-01-01' ELSE '2024-02-01' END AS snapshot_date, 'd' || doc_id AS decision_id FROM s WHERE later = 0 OR doc_id % 2 = 0)"""


def snapshots(spark, sf_dir):
    s = table(spark, sf_dir, "documents").select(F.col("source").alias("source_key"), (2000 + F.col("doc_id") % 3).cast("int").alias("snapshot_year"), "doc_id")

    def one(rows, day, base):
        g = rows.groupBy("source_key", "snapshot_year").agg(F.array_sort(F.collect_list(F.concat(F.lit("d"), F.col("doc_id").cast("string")))).alias("expected_ids"))
        return g.select((F.lit(base) + F.col("snapshot_year")).cast("long").alias("id"), "source_key", "snapshot_year", F.lit(day).alias("snapshot_date"), F.size("expected_ids").alias("expected_count"), "expected_ids")

    return one(s, "2024-01-01", 0).unionByName(one(s.where("doc_id % 2 = 0 AND snapshot_year <> 2001"), "2024-02-01", 10_000))


def ingested(spark, sf_dir):
    return decisions(spark, sf_dir).where("doc_id % 7 <> 0").select("decision_id", F.col("source_id").alias("court"), "decision_date")


@query(
    f"""WITH {SNAPSHOTS} SELECT source_key, snapshot_year, min(snapshot_date) AS snapshot_date, count(*) AS expected, count(CASE WHEN CAST(substring(decision_id, 2) AS BIGINT) % 7 <> 0 THEN 1 END) AS ingested,
        count(CASE WHEN CAST(substring(decision_id, 2) AS BIGINT) % 7 = 0 THEN 1 END) AS missing, round(count(CASE WHEN CAST(substring(decision_id, 2) AS BIGINT) % 7 <> 0 THEN 1 END) / count(*), 4) AS coverage
    FROM latest GROUP BY source_key, snapshot_year"""
)
def gap_report(spark, sf_dir):
    return coverage.gap_report(snapshots(spark, sf_dir), ingested(spark, sf_dir))


QUEUE_SQL = """q AS (SELECT source_key, snapshot_year AS decision_year, decision_id, CASE CAST(substring(decision_id, 2) AS BIGINT) % 5 WHEN 0 THEN 'ignored' WHEN 1 THEN 'resolved' WHEN 2 THEN 'open' ELSE 'retrying' END AS status,
    CAST(CAST(substring(decision_id, 2) AS BIGINT) % 3 AS INT) AS retry_count FROM latest WHERE CAST(substring(decision_id, 2) AS BIGINT) % 4 = 0)"""


def queue(spark, sf_dir):
    k = F.substring("decision_id", 2, 20).cast("long")
    rows = coverage.expected(snapshots(spark, sf_dir)).withColumn("k", k).where("k % 4 = 0")
    status = F.when(F.col("k") % 5 == 0, "ignored").when(F.col("k") % 5 == 1, "resolved").when(F.col("k") % 5 == 2, "open").otherwise("retrying")
    null = F.lit(None).cast("string")
    return rows.select("source_key", F.col("snapshot_year").alias("decision_year"), "decision_id", status.alias("status"), (F.col("k") % 3).cast("int").alias("retry_count"), *(null.alias(c) for c in ("next_retry_at", "first_seen_at", "last_seen_at", "last_error", "resolved_at", "resolution")))


@query(
    f"""WITH {SNAPSHOTS}, {QUEUE_SQL}, f AS (SELECT DISTINCT source_key, snapshot_year AS decision_year, decision_id FROM latest WHERE CAST(substring(decision_id, 2) AS BIGINT) % 6 = 0)
    SELECT source_key, decision_year, decision_id, CASE WHEN f.decision_id IS NULL THEN q.status WHEN q.status = 'ignored' THEN 'ignored' ELSE 'retrying' END AS status,
        CAST(CASE WHEN f.decision_id IS NULL OR q.status = 'ignored' THEN q.retry_count ELSE coalesce(q.retry_count, 0) + 1 END AS INT) AS retry_count,
        CASE WHEN f.decision_id IS NOT NULL AND coalesce(q.status, '') <> 'ignored' THEN '2024-07-01' END AS next_retry_at
    FROM q FULL JOIN f USING (source_key, decision_year, decision_id)"""
)
def gap_failures(spark, sf_dir):
    failed = coverage.expected(snapshots(spark, sf_dir)).where(F.substring("decision_id", 2, 20).cast("long") % 6 == 0)
    failed = failed.select("source_key", F.col("snapshot_year").alias("decision_year"), "decision_id", F.lit("timeout").alias("error"))
    return coverage.apply_failures(queue(spark, sf_dir), failed, "2024-06-30").select(*coverage.KEY, "status", "retry_count", "next_retry_at")


@query(
    f"""WITH {SNAPSHOTS}, {QUEUE_SQL}, m AS (SELECT source_key, snapshot_year AS decision_year, decision_id FROM latest WHERE CAST(substring(decision_id, 2) AS BIGINT) % 7 = 0)
    SELECT source_key, decision_year, decision_id, CASE WHEN m.decision_id IS NOT NULL THEN CASE WHEN q.status = 'ignored' THEN 'ignored' ELSE 'open' END WHEN q.status IN ('open', 'retrying') THEN 'resolved' ELSE q.status END AS status,
        coalesce(q.retry_count, 0) AS retry_count, CASE WHEN m.decision_id IS NULL AND q.status IN ('open', 'retrying') THEN 'snapshot_reconciled' END AS resolution
    FROM q FULL JOIN m USING (source_key, decision_year, decision_id)"""
)
def gap_transition(spark, sf_dir):
    return coverage.reconcile(queue(spark, sf_dir), snapshots(spark, sf_dir), ingested(spark, sf_dir), "2024-06-30").select(*coverage.KEY, "status", "retry_count", "resolution")


@query("SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS published, count(l) AS captured, round(count(l) * 100 / count(*), 1) AS rate FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS l FROM lineitem WHERE l_discount > 0.08) ON l = o_orderkey GROUP BY 1")
def capture_rate(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderkey").alias("decision_id"))
    return coverage.capture_rate(o, table(spark, sf_dir, "lineitem").where("l_discount > 0.08").select(F.col("l_orderkey").alias("decision_id")))


@query("SELECT event_id, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS attempt FROM events")
def attempt_numbers(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("run_id"), F.col("user_id").alias("decision_id"), F.col("ts").alias("fetched_at"))
    return coverage.attempts(e).select("event_id", F.col("attempt").cast("long").alias("attempt"))


JUDGED = """r AS (SELECT doc_id % 20 AS query_id, doc_id AS doc, row_number() OVER (PARTITION BY doc_id % 20 ORDER BY md5(CAST(doc_id AS VARCHAR))) AS rank FROM documents),
g AS (SELECT doc_id % 20 AS query_id, doc_id AS doc, quality + 2 * toxic AS grade FROM labels),
b AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY grade DESC, doc) AS i FROM g WHERE grade > 0),
ideal AS (SELECT query_id, count(*) AS relevant, sum(CASE WHEN i <= 10 THEN (pow(2, grade) - 1) / log2(i + 1) END) AS e, sum(CASE WHEN i <= 10 THEN grade / log2(i + 1) END) AS l FROM b GROUP BY query_id),
f AS (SELECT r.query_id, rank, grade, row_number() OVER (PARTITION BY r.query_id ORDER BY rank) AS i FROM r JOIN g ON g.query_id = r.query_id AND g.doc = r.doc WHERE rank <= 10 AND grade > 0),
s AS (SELECT query_id, 1 / min(rank) AS rr, count(*) AS n, max(CASE WHEN rank = 1 THEN 1.0 ELSE 0.0 END) AS hit1, sum((pow(2, grade) - 1) / log2(i + 1)) AS a, sum((pow(2, grade) - 1) / log2(rank + 1)) AS x, sum(grade / log2(rank + 1)) AS c FROM f GROUP BY query_id),
m AS (SELECT query_id, coalesce(rr, 0) AS rr, coalesce(n, 0) / relevant AS recall, coalesce(hit1, 0) AS hit1, coalesce(a / e, 0) AS ndcg_compressed, coalesce(x / e, 0) AS ndcg, coalesce(c / l, 0) AS ndcg_linear FROM ideal LEFT JOIN s USING (query_id))"""
METRICS = ("rr", "recall", "hit1", "ndcg_compressed", "ndcg", "ndcg_linear")


def measured(spark, sf_dir):
    w = Window.partitionBy(F.col("doc_id") % 20).orderBy(F.md5(F.col("doc_id").cast("string")))
    results = table(spark, sf_dir, "documents").select((F.col("doc_id") % 20).alias("query_id"), F.col("doc_id").alias("doc"), F.row_number().over(w).alias("rank"))
    grades = table(spark, sf_dir, "labels").select((F.col("doc_id") % 20).alias("query_id"), F.col("doc_id").alias("doc"), (F.col("quality") + 2 * F.col("toxic")).alias("grade"))
    return evaluate.per_query(results, grades, 10)


@query(f"WITH {JUDGED} SELECT query_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in METRICS) + " FROM m")
def ir_metrics(spark, sf_dir):
    return measured(spark, sf_dir).select("query_id", *(F.round(c, 6).alias(c) for c in METRICS))


@query(f"WITH {JUDGED} SELECT count(*) AS queries, " + ", ".join(f"round(avg({c}), 6) AS {c}" for c in METRICS) + " FROM m")
def ir_summary(spark, sf_dir):
    return evaluate.summary(measured(spark, sf_dir)).select("queries", *(F.round(c, 6).alias(c) for c in METRICS))


@query("WITH v AS (SELECT list_sort(list(value)) AS l, avg(value) AS mean FROM events) SELECT round(mean, 6) AS mean, round(l[greatest(CAST(floor(len(l) * 0.95) AS BIGINT), 1)], 6) AS p95 FROM v")
def latency_gate(spark, sf_dir):
    return evaluate.latency(table(spark, sf_dir, "events"), "value").select(F.round("mean", 6).alias("mean"), F.round("p95", 6).alias("p95"))


@query("WITH a AS (SELECT event_type AS k, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY 1), b AS (SELECT event_type AS k, count(*) AS n FROM events WHERE event_id % 3 = 0 GROUP BY 1) SELECT k, coalesce(a.n, 0) AS n_a, coalesce(b.n, 0) AS n_b, coalesce(b.n, 0) - coalesce(a.n, 0) AS difference FROM a FULL JOIN b USING (k)")
def release_difference(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumnRenamed("event_type", "k")
    return evaluate.profile_difference(e.where("event_id % 2 = 0").groupBy("k").agg(F.count("*").alias("n")), e.where("event_id % 3 = 0").groupBy("k").agg(F.count("*").alias("n")), "k")


@query(f"{WITH} SELECT decision_id FROM decisions WHERE court = 'bger' AND language = 'de' AND decision_date >= '2000-01-01' AND decision_date <= '2015-12-31'")
def conjunctive_filters(spark, sf_dir):
    from ..operators.search import conjunctive

    return decisions(spark, sf_dir).where(conjunctive(court="bger", language="DE", date_from="2000-01-01", date_to="2015-12-31")).select("decision_id")
