"""Named queries over the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "find_decisions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is any."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


@query(
    """SELECT source, lang, count(*) AS n_docs, sum(n_chars) AS n_chars, min(n_chars) AS shortest, max(n_chars) AS longest
    FROM documents GROUP BY source, lang"""
)
def stats_by_source_lang(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source", "lang").agg(
        F.count("*").alias("n_docs"), F.sum("n_chars").alias("n_chars"), F.min("n_chars").alias("shortest"), F.max("n_chars").alias("longest")
    )
