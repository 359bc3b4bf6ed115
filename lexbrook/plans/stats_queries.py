"""Statistics and quality reports over derived decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality, stats
from .base import TODAY, WITH, decisions
from .registry import query, table

VALID = f"decision_date IS NOT NULL AND decision_date <> 'None' AND decision_date > '1800-01-01' AND decision_date <= '{TODAY}'"
LIMIT = "2020-01-01"


@query(
    f"""{WITH} SELECT court, canton, count(*) AS n, min(CASE WHEN {VALID} THEN decision_date END) AS earliest, max(CASE WHEN {VALID} THEN decision_date END) AS latest, max(scraped_at) AS last_scraped,
        string_agg(DISTINCT language, ',' ORDER BY language) AS languages FROM decisions GROUP BY court, canton"""
)
def stats_by_court(spark, sf_dir):
    return stats.by_court(decisions(spark, sf_dir), TODAY)


@query(
    f"""{WITH} SELECT canton, count(*) AS n, count(DISTINCT court) AS courts, min(CASE WHEN {VALID} THEN decision_date END) AS earliest,
        max(CASE WHEN decision_date IS NOT NULL AND decision_date <> 'None' AND decision_date <= '{TODAY}' THEN decision_date END) AS latest, string_agg(DISTINCT language, ',' ORDER BY language) AS languages
    FROM decisions WHERE canton <> 'CH' GROUP BY canton"""
)
def stats_by_canton(spark, sf_dir):
    return stats.by_canton(decisions(spark, sf_dir), TODAY)


@query(f"{WITH} SELECT language, count(*) AS n, language NOT IN ('de', 'fr', 'it', 'rm') AS unexpected FROM decisions GROUP BY language")
def lang_share_unexpected(spark, sf_dir):
    return quality.language_report(decisions(spark, sf_dir))


YEAR = "substring(decision_date, 1, 4)"
DATED = "decision_date IS NOT NULL AND decision_date <> 'None' AND length(decision_date) >= 4"


@query(f"{WITH} SELECT {YEAR} AS year, count(*) AS n FROM decisions WHERE {DATED} AND {YEAR} BETWEEN '1800' AND '2100' GROUP BY 1")
def stats_by_year(spark, sf_dir):
    return stats.by_year(decisions(spark, sf_dir))


@query(f"{WITH} SELECT {YEAR} AS year, language, count(*) AS n FROM decisions WHERE {DATED} AND {YEAR} BETWEEN '2005' AND '2024' GROUP BY 1, 2")
def language_by_year(spark, sf_dir):
    return stats.language_by_year(decisions(spark, sf_dir), "2005", "2024")


@query("SELECT source, " + ", ".join(f"count(CASE WHEN lang = '{x}' THEN 1 END) AS n_{x}" for x in ("de", "fr", "en", "es")) + " FROM documents GROUP BY source")
def lang_by_source_matrix(spark, sf_dir):
    return stats.language_matrix(table(spark, sf_dir, "documents").withColumnRenamed("lang", "language"), ["de", "fr", "en", "es"], "source")


@query("SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-06-01' AND DATE '1997-07-01' GROUP BY 1")
def recent_daily(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").cast("string").alias("decision_date"))
    return stats.recent_days(o, "1997-07-01", 30)


@query("SELECT substring(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 7) AS month, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1994-07-01' AND CAST(o_orderdate AS DATE) <= DATE '1997-07-01' GROUP BY 1")
def monthly_counts(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").cast("string").alias("decision_date"))
    return stats.by_month(o, "1997-07-01", 3)


@query(f"{WITH} SELECT min(decision_date) AS earliest, max(decision_date) AS latest FROM decisions WHERE {VALID}")
def date_range(spark, sf_dir):
    return stats.date_range(decisions(spark, sf_dir), TODAY)


@query(f"{WITH} SELECT count(CASE WHEN canton = 'CH' THEN 1 END) AS federal, count(CASE WHEN canton <> 'CH' THEN 1 END) AS cantonal FROM decisions")
def federal_split(spark, sf_dir):
    return stats.federal_split(decisions(spark, sf_dir))


@query("WITH c AS (SELECT year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY 1), p AS (SELECT *, lag(n) OVER (ORDER BY year) AS b FROM c) SELECT CAST(year AS INT) AS year, round((n - b) / b * 100, 1) AS growth FROM p WHERE b > 0")
def yoy_growth(spark, sf_dir):
    return stats.growth(stats.counted(table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")), "year"))


@query(f"{WITH} SELECT court, count(*) AS n FROM decisions GROUP BY court ORDER BY n DESC, court LIMIT 3")
def top_courts(spark, sf_dir):
    return stats.top(stats.counted(decisions(spark, sf_dir), "court"), 3, F.desc("n"), "court")


@query(
    f"""{WITH} SELECT decision_id, decision_date FROM decisions WHERE court IN ('bger', 'bge') AND decision_date IS NOT NULL AND decision_date <> '' AND decision_date <= '{TODAY}' AND length(full_text) > 500
    AND NOT full_text ILIKE '%Document Dienstes ist fehlgeschlagen%' ORDER BY decision_date DESC, decision_id DESC LIMIT 10"""
)
def recent_topk(spark, sf_dir):
    return stats.latest_readable(decisions(spark, sf_dir), TODAY, 10, ["bger", "bge"]).select("decision_id", "decision_date")


@query(
    """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2) SELECT event_type, day, n, n - lag(n) OVER (PARTITION BY event_type ORDER BY day) AS delta FROM d"""
)
def daily_delta(spark, sf_dir):
    d = table(spark, sf_dir, "events").groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    return stats.delta_to_earlier(d, ["event_type"], "day", "n")


@query("SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) - 1) / 500) AS BIGINT) AS page FROM orders")
def sitemap_pages(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return stats.page_of(o, [F.desc("o_orderdate"), F.col("o_orderkey")], 500).select("o_orderkey", F.col("page").cast("long").alias("page"))


@query("WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang) SELECT lang, n, CAST(unnest(range(1, CAST(floor(n / 100) AS BIGINT) + 2)) AS INT) AS chunk FROM c")
def sitemap_chunks(spark, sf_dir):
    return stats.sitemap_chunks(table(spark, sf_dir, "documents"), 100, "lang")


@query("SELECT source, count(*) AS n, avg(n_chars) AS mean, count(CASE WHEN n_chars < 1000 THEN 1 END) AS short, count(CASE WHEN n_chars = 0 THEN 1 END) AS empty FROM documents GROUP BY source")
def text_length_by_source(spark, sf_dir):
    return stats.text_lengths(table(spark, sf_dir, "documents"), "n_chars", "source")


@query(
    """SELECT count(*) AS total, count(CASE WHEN n_chars = 0 THEN 1 END) AS empty, count(CASE WHEN n_chars BETWEEN 1 AND 499 THEN 1 END) AS stub, count(CASE WHEN n_chars BETWEEN 500 AND 999 THEN 1 END) AS short,
    count(CASE WHEN n_chars BETWEEN 1000 AND 2999 THEN 1 END) AS thin, count(CASE WHEN n_chars >= 3000 THEN 1 END) AS normal FROM documents"""
)
def length_histogram(spark, sf_dir):
    return stats.length_histogram(table(spark, sf_dir, "documents"), "n_chars")


@query(
    """WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) - 1 AS k, count(*) OVER (PARTITION BY source) AS n FROM documents)
    SELECT source, max(CASE WHEN k = 0 THEN doc_id END) AS shortest, max(CASE WHEN k = CAST(floor(n / 2) AS BIGINT) THEN doc_id END) AS median FROM r GROUP BY source"""
)
def stub_samples(spark, sf_dir):
    return stats.stub_samples(table(spark, sf_dir, "documents"), "source", "n_chars", "doc_id")


@query(f"{WITH} SELECT court, count(CASE WHEN length(trim(coalesce(regeste, ''))) = 0 THEN 1 END) AS empty, count(*) AS total, count(CASE WHEN length(trim(coalesce(regeste, ''))) = 0 THEN 1 END) * 100.0 / count(*) AS share FROM decisions GROUP BY court HAVING empty > 0")
def empty_headnotes(spark, sf_dir):
    return stats.empty_share(decisions(spark, sf_dir), "court", "regeste")


NULLISH = "(decision_date IS NULL OR decision_date = '' OR decision_date = 'None')"
FUTURE = f"coalesce(decision_date > '{LIMIT}', false)"
OLD = f"(NOT {NULLISH} AND decision_date < '1800-01-01')"
SHORT_DATE = f"(NOT {NULLISH} AND length(decision_date) < 10)"


@query(
    f"""{WITH} SELECT count(*) AS total, count(CASE WHEN {NULLISH} THEN 1 END) AS null_or_empty, count(CASE WHEN {FUTURE} THEN 1 END) AS future, count(CASE WHEN {OLD} THEN 1 END) AS pre_1800,
        count(CASE WHEN {SHORT_DATE} THEN 1 END) AS invalid_format, count(CASE WHEN {NULLISH} OR {FUTURE} OR {OLD} OR {SHORT_DATE} THEN 1 END) AS anomalies,
        round(count(CASE WHEN {NULLISH} OR {FUTURE} OR {OLD} OR {SHORT_DATE} THEN 1 END) / count(*) * 100, 3) AS anomaly_pct FROM decisions"""
)
def quality_dates(spark, sf_dir):
    return quality.date_report(decisions(spark, sf_dir), LIMIT)


SHORT_TEXT = "length(coalesce(full_text, '')) < 50"
PLACEHOLDER = "(full_text ILIKE '%[Text extraction failed%' OR full_text ILIKE '%(metadata only)%')"


@query(
    f"""{WITH} SELECT count(*) AS total, count(CASE WHEN {SHORT_TEXT} THEN 1 END) AS short, count(CASE WHEN {PLACEHOLDER} THEN 1 END) AS placeholder, count(CASE WHEN {SHORT_TEXT} THEN 1 END) + count(CASE WHEN {PLACEHOLDER} THEN 1 END) AS missing,
        round((count(CASE WHEN {SHORT_TEXT} THEN 1 END) + count(CASE WHEN {PLACEHOLDER} THEN 1 END)) / count(*) * 100, 3) AS missing_pct FROM decisions"""
)
def quality_text_report(spark, sf_dir):
    return quality.text_report(decisions(spark, sf_dir))


@query(
    f"""{WITH} SELECT court, canton, count(*) AS total, count(CASE WHEN {NULLISH} THEN 1 END) AS date_missing, count(CASE WHEN {SHORT_TEXT} THEN 1 END) AS text_missing, count(CASE WHEN {FUTURE} THEN 1 END) AS date_future,
        min(CASE WHEN decision_date <> 'None' AND decision_date > '1800-01-01' THEN decision_date END) AS earliest, max(CASE WHEN decision_date <> 'None' AND decision_date < '2100-01-01' THEN decision_date END) AS latest,
        round((1 - (count(CASE WHEN {NULLISH} THEN 1 END) + count(CASE WHEN {SHORT_TEXT} THEN 1 END)) / count(*)) * 100, 1) AS quality_score FROM decisions GROUP BY court, canton"""
)
def quality_by_court(spark, sf_dir):
    return quality.court_report(decisions(spark, sf_dir), LIMIT)


@query(
    f"""{WITH}, q AS (SELECT round(count(CASE WHEN {NULLISH} OR {FUTURE} OR {OLD} OR {SHORT_DATE} THEN 1 END) / count(*) * 100, 3) AS d,
        round((count(CASE WHEN {SHORT_TEXT} THEN 1 END) + count(CASE WHEN {PLACEHOLDER} THEN 1 END)) / count(*) * 100, 3) AS t FROM decisions) SELECT round(((1 - d / 100) * 0.5 + (1 - t / 100) * 0.5) * 100, 1) AS score FROM q"""
)
def quality_overall(spark, sf_dir):
    return quality.overall_score(decisions(spark, sf_dir), LIMIT)


@query(
    "SELECT count(CASE WHEN html ILIKE '%<br%' THEN 1 END) AS br, count(CASE WHEN html ILIKE '%<p>%' OR html ILIKE '%<div>%' THEN 1 END) AS blocks, count(CASE WHEN html ILIKE '%&nbsp;%' THEN 1 END) AS nbsp, "
    "count(CASE WHEN html ILIKE '%Ã¤%' THEN 1 END) AS ae, count(CASE WHEN html ILIKE '%Ã¶%' THEN 1 END) AS oe, count(CASE WHEN html ILIKE '%Ã¼%' THEN 1 END) AS ue, count(CASE WHEN html ILIKE '%Â§%' THEN 1 END) AS section FROM pages"
)
def artefacts(spark, sf_dir):
    return quality.artefacts(table(spark, sf_dir, "pages"), "html")


@query(f"{WITH} SELECT count(*) AS total, count(CASE WHEN length(coalesce(full_text, '')) < 500 THEN 1 END) AS short, count(CASE WHEN length(trim(coalesce(regeste, ''))) = 0 THEN 1 END) AS no_regeste, count(CASE WHEN length(trim(coalesce(decision_date, ''))) = 0 THEN 1 END) AS no_date FROM decisions")
def quality_summary(spark, sf_dir):
    return quality.quality_summary(decisions(spark, sf_dir))


@query(
    f"""{WITH} SELECT decision_id, CASE WHEN {NULLISH} THEN CASE WHEN court IN ('bger') THEN '2019-01-01' WHEN court = 'bvger' THEN '2020-01-01' ELSE decision_date END ELSE decision_date END AS decision_date FROM decisions WHERE court IN ('bger', 'bvger')"""
)
def repaired_dates(spark, sf_dir):
    d = decisions(spark, sf_dir).where("court IN ('bger', 'bvger')")
    d = d.withColumn("docket_number", F.when(F.col("court") == "bvger", "E-12/2020").otherwise("4A_1/2019")).withColumn("full_text", F.lit(""))
    return quality.with_repaired_date(d).select("decision_id", "decision_date")


@query(f"{WITH} SELECT decision_id, unnest([x for x in [CASE WHEN language NOT IN ('de', 'fr', 'it', 'rm') THEN 'language' END] if x IS NOT NULL]) AS rule FROM decisions")
def violations(spark, sf_dir):
    return quality.violations(decisions(spark, sf_dir)).where("rule <> 'date'")
