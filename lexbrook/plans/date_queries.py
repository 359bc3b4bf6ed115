"""Dates told by texts, over documents with headings and sign-offs in eight spellings around the whole text."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import repair
from .base import TODAY, WITH, decisions
from .registry import query, table

FILLER = "Das Gericht hat in dieser Sache Folgendes erwogen und entschieden."
HEADS = [
    "Urteil vom 5. März 2019", "Arrêt du 1er février 2020", "Sentenza del 4 maggio 2018", "Am 7. Juni 2011 im Fall", "", "Urteil vom 5. März 2015",
    "nach dem Gesetz vom 17. Juni 2005, und das ist hier schon alles dazu gesagt, am 9. Mai 2012 im Saal", "Datum 23.02.2016",
]
TAILS = ["Lausanne, 5. März 2019", "Fribourg, le 4 février 2020", "", "Zürich, den 1. Juli 2014", "Bellinzona, il 3 agosto 2017", "Bern, 1. Januar 2018", "", ""]
EXPECTED = [("2019-03-05", "both", "high"), ("2020-02-01", "header_fr", "medium"), ("2018-05-04", "header_it", "high"), ("2014-07-01", "signoff", "medium"), ("2017-08-03", "signoff", "medium"), ("2018-01-01", "signoff", "medium"), ("2012-05-09", "bare_header", "medium"), ("2016-02-23", "numeric", "low")]
KNOWN = "CASE doc_id % 3 WHEN 0 THEN '2019-03-05' WHEN 1 THEN '2001-01-01' END"


def told(spark, sf_dir):
    """Decisions whose whole text stands between a heading and a sign-off."""
    k = (F.col("doc_id") % 8).cast("int")
    head, tail = (F.element_at(F.array(*map(F.lit, x)), k + 1) for x in (HEADS, TAILS))
    body = F.concat_ws("\n", head, F.lit(" ".join([FILLER] * 10)), "text", F.lit(FILLER), tail)
    return table(spark, sf_dir, "documents").select("doc_id", body.alias("full_text"), F.expr(KNOWN).alias("decision_date"))


def chosen(i: int, default: str = "NULL") -> str:
    return "CASE doc_id % 8 " + " ".join(f"WHEN {k} THEN '{x[i]}'" for k, x in enumerate(EXPECTED)) + f" ELSE {default} END"


CATEGORY = f"CASE WHEN known IS NULL THEN 'NULL_METADATA_FIXABLE' WHEN known = d THEN 'MATCH' WHEN c <> 'low' THEN 'MISMATCH_FIXABLE' ELSE 'MISMATCH_AMBIGUOUS' END"
FOUND = f"f AS (SELECT doc_id, {chosen(0)} AS d, {chosen(1)} AS m, {chosen(2)} AS c, {KNOWN} AS known FROM documents)"


@query(f"WITH {FOUND} SELECT doc_id, CAST(d AS DATE) AS found, m AS method, c AS confidence, {CATEGORY} AS category FROM f")
def arbitrated_dates(spark, sf_dir):
    d = told(spark, sf_dir).withColumn("x", dates.decision_date("full_text"))
    return d.select("doc_id", F.col("x.date").alias("found"), "x.method", "x.confidence", dates.category(F.col("x"), "decision_date").alias("category"))


@query(f"""WITH {FOUND}, g AS (SELECT *, {CATEGORY} AS category FROM f), h AS (SELECT *, category IN ('MISMATCH_FIXABLE', 'NULL_METADATA_FIXABLE') AND c <> 'low' AS fix FROM g)
    SELECT doc_id, CASE WHEN fix THEN d ELSE known END AS decision_date, CASE WHEN fix AND category = 'MISMATCH_FIXABLE' THEN known END AS publication_date, category AS date_category FROM h""")
def repaired_by_text(spark, sf_dir):
    return repair.repaired_dates(told(spark, sf_dir), TODAY).select("doc_id", "decision_date", "publication_date", "date_category")


@query(f"WITH {FOUND} SELECT {CATEGORY} AS date_category, count(*) AS n FROM f GROUP BY 1")
def date_audit(spark, sf_dir):
    return repair.date_audit(told(spark, sf_dir))


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '2019-03-05' WHEN 1 THEN '2021-12-24' WHEN 2 THEN '2018-07-09' END AS found FROM documents""")
def nearest_dates(spark, sf_dir):
    k = (F.col("doc_id") % 4).cast("int") + 1
    s = F.element_at(F.array(*map(F.lit, ["vom 5. März 2019 und 1.1.2001", "am 24.12.2021 und 2001-01-01", "ISO 2018-07-09", "1. März 1850, 31.12.1899"])), k)
    return table(spark, sf_dir, "documents").select("doc_id", dates.nearest_date(s).alias("found"))


@query(f"""{WITH} SELECT decision_id, CAST(coalesce(CASE WHEN regexp_matches(decision_date, '^[0-9]{{4}}') THEN substring(decision_date, 1, 4) END, nullif(regexp_extract(docket_number, '/((?:19|20)[0-9]{{2}})$', 1), '')) AS INTEGER) AS year
    FROM decisions""")
def decision_years(spark, sf_dir):
    return decisions(spark, sf_dir).select("decision_id", dates.decision_year("decision_date", "docket_number", F.lit("")).alias("year"))


@query(f"""{WITH}, k AS (SELECT *, (CASE WHEN court = 'bge' THEN 'bge' WHEN court IN ('zh_gerichte', 'zh_obergericht') THEN 'zh_arbeitsgericht' ELSE court END) || '|' || regexp_replace(regexp_replace(upper(docket_number), '[^A-Z0-9]', '', 'g'), CASE WHEN court = 'bge' THEN '^(CH)?(BGE|ATF|DTF)' ELSE '^$' END, '')
        || '|' || substring(replace(coalesce(decision_date, ''), '-', ''), 1, 8) AS key FROM decisions)
    SELECT decision_id FROM k WHERE length(full_text) < 500 AND key NOT IN (SELECT key FROM k WHERE length(full_text) >= 500)""")
def worth_repair(spark, sf_dir):
    d = decisions(spark, sf_dir)
    return repair.worth_repair(d.where(F.length("full_text") < 500), d, 500).select("decision_id")


@query("""WITH s AS (SELECT source, count(*) AS n, max(doc_id) AS high FROM documents GROUP BY source), m AS (SELECT source, count(*) AS n, max(doc_id) AS high FROM documents WHERE source NOT LIKE '%1' GROUP BY source)
    SELECT s.source, s.n, s.high FROM s LEFT JOIN m USING (source, n, high) WHERE m.source IS NULL""")
def changed_sources(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumnRenamed("source", "src")
    return repair.changed_since(repair.high_water(d.where("src NOT LIKE '%1'"), "src", "doc_id"), repair.high_water(d, "src", "doc_id"))
