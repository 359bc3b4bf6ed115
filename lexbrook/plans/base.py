"""Tables that queries derive from the driver's tables, by SQL that both engines run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .registry import table

TODAY = "2024-06-30"

#: Decisions made of documents: dockets and dates repeat, so that there is something to de-duplicate and to cite.
DECISIONS = """SELECT doc_id, 'd' || CAST(doc_id AS STRING) AS decision_id,
    CASE doc_id % 5 WHEN 0 THEN 'bger' WHEN 1 THEN 'bge' WHEN 2 THEN 'bvger' WHEN 3 THEN 'zh_obergericht' ELSE 'zh_gerichte' END AS court,
    CASE WHEN doc_id % 5 < 3 THEN 'CH' ELSE 'ZH' END AS canton,
    CASE doc_id % 5 WHEN 0 THEN '4A_' || CAST(doc_id % 200 AS STRING) || '/2019'
        WHEN 1 THEN CASE WHEN doc_id % 3 = 0 THEN 'BGE ' ELSE '' END || CAST(100 + doc_id % 50 AS STRING) || ' III ' || CAST(doc_id % 200 AS STRING)
        WHEN 2 THEN 'E-' || CAST(1000 + doc_id % 200 AS STRING) || '/2020'
        ELSE 'LB' || CAST(CAST(floor(doc_id / 5) AS BIGINT) % 60 AS STRING) || '-U' END AS docket_number,
    lang AS language,
    CASE WHEN doc_id % 37 = 0 THEN '' WHEN doc_id % 41 = 0 THEN 'None' WHEN doc_id % 43 = 0 THEN NULL WHEN doc_id % 47 = 0 THEN '2015'
        ELSE CAST(DATE '1995-01-01' + CAST((doc_id % 200) * 53 AS INT) AS STRING) END AS decision_date,
    'Entscheid ' || substring(text, 1, 30) AS title,
    CASE doc_id % 3 WHEN 0 THEN substring(text, 1, 150) WHEN 1 THEN '' END AS regeste,
    text AS full_text, source AS source_id,
    CAST(DATE '2024-01-01' + CAST(doc_id % 365 AS INT) AS STRING) AS scraped_at,
    'Vgl. BGE ' || CAST(100 + (doc_id + 1) % 50 AS STRING) || ' III ' || CAST((doc_id + 1) % 200 AS STRING)
        || ' und Urteil 4A_' || CAST((doc_id - doc_id % 5 + 195) % 200 AS STRING) || '/2019 sowie '
        || CAST(100 + (doc_id + 6) % 50 AS STRING) || ' III ' || CAST((doc_id + 6) % 200 AS STRING)
        || '. Art. ' || CAST(doc_id % 50 + 1 AS STRING) || ' Abs. ' || CAST(doc_id % 4 + 1 AS STRING)
        || ' OR, Art. ' || CAST(doc_id % 30 + 1 AS STRING) || ' ZGB und art. 5 der Verfassung.' AS refs
FROM {documents}"""

WITH = "WITH decisions AS (" + DECISIONS.replace("{documents}", "documents") + ")"


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DECISIONS, documents=table(spark, sf_dir, "documents"))
