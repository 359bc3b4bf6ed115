"""De-duplication, upserts, set operations and export over derived decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import canonical_key
from ..operators import dedup, quality
from .base import WITH, decisions
from .registry import query, table
from .text_queries import CANONICAL

KEYED = f"{WITH}, k AS (SELECT *, {CANONICAL} AS canonical_key FROM decisions)"
HAS = "CASE WHEN length(coalesce(regeste, '')) > 0 THEN 0 ELSE 1 END"
CONTENT = "length(full_text) + length(coalesce(regeste, ''))"


def keyed(spark, sf_dir):
    return decisions(spark, sf_dir).withColumn("canonical_key", canonical_key("court", "docket_number", "decision_date"))


FIRST = f"one AS (SELECT *, row_number() OVER (PARTITION BY CASE WHEN canonical_key LIKE '%||%' THEN decision_id ELSE canonical_key END ORDER BY {HAS}, length(full_text) DESC, decision_id) AS a FROM k)"


@query(f"{KEYED}, {FIRST} SELECT decision_id, canonical_key FROM one WHERE a = 1")
def dedup_best_version(spark, sf_dir):
    return dedup.best_version(keyed(spark, sf_dir)).select("decision_id", "canonical_key")


SECOND = f"two AS (SELECT *, row_number() OVER (PARTITION BY CASE WHEN string_split(canonical_key, '|')[2] = '' THEN decision_id ELSE string_split(canonical_key, '|')[1] || '|' || string_split(canonical_key, '|')[2] END ORDER BY {CONTENT} DESC, decision_id) AS b FROM one WHERE a = 1)"


@query(f"{KEYED}, {FIRST}, {SECOND} SELECT decision_id FROM two WHERE b = 1")
def dedup_pass2(spark, sf_dir):
    return dedup.best_version_any_date(dedup.best_version(keyed(spark, sf_dir))).select("decision_id")


@query(f"{WITH} SELECT decision_id FROM (SELECT *, row_number() OVER (PARTITION BY court, docket_number, decision_date ORDER BY {HAS}, length(full_text) DESC, decision_id) AS a FROM decisions) WHERE a = 1")
def dedup_by_docket(spark, sf_dir):
    return dedup.best_version_by_docket(decisions(spark, sf_dir)).select("decision_id")


THIRD = f"""three AS (SELECT *, row_number() OVER (PARTITION BY CASE WHEN court LIKE 'zh_%' THEN regexp_replace(upper(docket_number), '[^A-Z0-9]', '', 'g') || '|' || substring(replace(coalesce(decision_date, ''), '-', ''), 1, 8) ELSE decision_id END
    ORDER BY {CONTENT} DESC, decision_id) AS c FROM two WHERE b = 1)"""


@query(f"{KEYED}, {FIRST}, {SECOND}, {THIRD} SELECT decision_id FROM three WHERE c = 1")
def dedup_across_courts(spark, sf_dir):
    return dedup.best_across_courts(dedup.best_version_any_date(dedup.best_version(keyed(spark, sf_dir)))).select("decision_id")


@query(f"{WITH} SELECT decision_id FROM decisions WHERE NOT (length(full_text) < 10 AND length(coalesce(regeste, '')) < 10)")
def stub_filter(spark, sf_dir):
    return dedup.without_stubs(decisions(spark, sf_dir)).select("decision_id")


@query(
    f"""{WITH}, n AS (SELECT decision_id, docket_number, court, doc_id, row_number() OVER (PARTITION BY docket_number ORDER BY doc_id) AS k FROM decisions WHERE doc_id % 2 = 0)
    SELECT docket_number, decision_id FROM n WHERE k = 1 AND docket_number NOT IN (SELECT docket_number FROM decisions WHERE doc_id % 10 = 1 OR doc_id % 20 = 4)"""
)
def insert_or_ignore(spark, sf_dir):
    d = decisions(spark, sf_dir)
    new, old = d.where("doc_id % 2 = 0"), d.where("doc_id % 10 = 1 OR doc_id % 20 = 4")
    return dedup.insert_or_ignore(new, old, ["docket_number"], [F.col("doc_id")], dedup.REQUIRED).select("docket_number", "decision_id")


@query(
    """SELECT o_orderkey, round(CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice * 2 ELSE o_totalprice END, 2) AS price FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0"""
)
def upsert_replace(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    out = dedup.upsert_replace(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0").withColumn("price", F.col("price") * 2), ["o_orderkey"])
    return out.select("o_orderkey", F.round("price", 2).alias("price"))


@query("SELECT key, max(event_id) AS event_id FROM (SELECT CASE WHEN user_id % 11 = 0 THEN NULL ELSE user_id END AS key, event_id FROM events) WHERE key IS NOT NULL GROUP BY key UNION ALL SELECT NULL, event_id FROM events WHERE user_id % 11 = 0")
def keep_last(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.when(F.col("user_id") % 11 == 0, F.lit(None)).otherwise(F.col("user_id")).cast("string").alias("key"), "event_id")
    return dedup.keep_last(e, "key", "event_id").select(F.col("key").cast("long").alias("key"), "event_id")


@query(
    f"""{WITH} SELECT decision_id, coalesce(nullif(nullif(decision_date, 'None'), '1970-01-01'), NULL) AS decision_date, trim(full_text) <> '' AS has_full_text, CAST(length(full_text) AS INT) AS text_length,
        CASE WHEN doc_id % 9 = 0 THEN 'XX' ELSE canton END AS canton FROM decisions WHERE doc_id % 13 <> 0"""
)
def export_rows(spark, sf_dir):
    d = decisions(spark, sf_dir)
    d = d.withColumn("canton", F.when(F.col("doc_id") % 9 == 0, "").otherwise(F.col("canton"))).withColumn("docket_number", F.when(F.col("doc_id") % 13 == 0, "").otherwise(F.col("docket_number")))
    chosen = dedup.export_rows(d.unionByName(d.where("doc_id % 4 = 0")), [F.col("doc_id")], ["decision_id", "court", "docket_number"])
    return dedup.normalized_for_export(chosen).select("decision_id", "decision_date", "has_full_text", "text_length", "canton")


@query(
    f"""{WITH}, known AS (SELECT * FROM decisions WHERE doc_id % 4 = 0), new AS (SELECT * FROM decisions WHERE doc_id % 4 <> 0)
    SELECT decision_id FROM new n WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.decision_id = n.decision_id) AND NOT EXISTS (SELECT 1 FROM known k WHERE k.court = n.court AND k.source_id = n.source_id)
        AND NOT EXISTS (SELECT 1 FROM known k WHERE k.court = n.court AND k.docket_number = n.docket_number
            AND CASE WHEN regexp_matches(coalesce(k.decision_date, ''), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN k.decision_date ELSE '' END = CASE WHEN regexp_matches(coalesce(n.decision_date, ''), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN n.decision_date ELSE '' END)"""
)
def cross_source_new(spark, sf_dir):
    d = decisions(spark, sf_dir)
    return dedup.not_yet_known(d.where("doc_id % 4 <> 0"), d.where("doc_id % 4 = 0")).select("decision_id")


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 0 ELSE 1 END AS shard FROM supplier")
def merge_shards(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey")
    return dedup.merge_shards([s.where("s_suppkey % 2 = 0").withColumn("shard", F.lit(0)), s.withColumn("shard", F.lit(1))], ["s_suppkey"])


@query("SELECT md5(text) AS hash, count(*) AS n, min('d' || doc_id) AS first_id FROM documents WHERE length(text) > 0 GROUP BY 1 HAVING count(*) > 1")
def content_hash_dupes(spark, sf_dir):
    return quality.content_duplicates(decisions(spark, sf_dir))


@query(f"{WITH} SELECT court, docket_number, count(*) AS n, string_agg(decision_id, '|' ORDER BY decision_id) AS ids FROM decisions GROUP BY court, docket_number HAVING count(*) > 1")
def duplicate_groups(spark, sf_dir):
    return quality.duplicate_groups(decisions(spark, sf_dir), "court", "docket_number")


@query(f"{WITH}, g AS (SELECT court, docket_number, count(*) AS n FROM decisions GROUP BY court, docket_number HAVING count(*) > 1) SELECT court, count(*) AS groups, CAST(sum(n - 1) AS BIGINT) AS superfluous FROM g GROUP BY court")
def duplicates_by_court(spark, sf_dir):
    return quality.duplicates_by_court(quality.duplicate_counts(decisions(spark, sf_dir), "court", "docket_number"))


@query(f"{WITH}, g AS (SELECT court, docket_number, min(decision_id) AS representative FROM decisions GROUP BY court, docket_number HAVING count(*) > 1) SELECT court, docket_number, decision_id, representative FROM decisions JOIN g USING (court, docket_number)")
def duplicate_members(spark, sf_dir):
    return quality.duplicate_members(decisions(spark, sf_dir), "court", "docket_number")
