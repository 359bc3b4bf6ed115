"""Repairs of records: dates that the text corrects, and what need not be repaired."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.text import alphanumeric, compact_date, text
from .dedup import OVERLAPS, overlap_group

LEAST_TEXT = 100


def repaired_dates(df: DataFrame, today: str, least: str = "medium") -> DataFrame:
    """df with decision_date corrected where the text says so surely enough, publication_date (the date that stood there), and
    date_category. Texts that are too short, and dates before 1900 or after today, change nothing."""
    found = df.withColumn("_d", dates.decision_date("full_text")).withColumn("date_category", dates.category(F.col("_d"), "decision_date"))
    level = F.array_position(F.array(*map(F.lit, dates.LEVELS)), F.col("_d.confidence"))
    d = F.col("_d.date")
    sure = F.col("date_category").isin("MISMATCH_FIXABLE", "NULL_METADATA_FIXABLE") & (level > dates.LEVELS.index(least)) & (F.length(text("full_text")) >= LEAST_TEXT) & d.between(F.lit("1900-01-01").cast("date"), F.lit(today).cast("date"))
    sure = F.coalesce(sure, F.lit(False))
    old = F.col("decision_date").cast("string")
    moved = F.when(sure & (F.col("date_category") == "MISMATCH_FIXABLE"), old)
    return found.withColumn("publication_date", moved).withColumn("decision_date", F.when(sure, d.cast("string")).otherwise(old)).drop("_d")


def date_audit(df: DataFrame, *keys) -> DataFrame:
    """How many records fall into each category."""
    told = df.select(*keys, "decision_date", dates.decision_date("full_text").alias("_d"))  # once a text, not once a comparison
    return told.select(*keys, dates.category(F.col("_d"), "decision_date").alias("date_category")).groupBy(*keys, "date_category").agg(F.count("*").alias("n"))


def decision_key():
    """court (of overlapping courts the first by name), docket in capitals and digits, and day: what records of one decision share."""
    group = F.element_at(F.array(*(F.lit(min(names.split())) for names in OVERLAPS)), overlap_group("court") + 1)
    docket = alphanumeric("docket_number")
    docket = F.when(F.col("court").isin("tg_gerichte", "tg_obergericht"), F.regexp_replace(docket, r"NR(?=\d)", "")).when(F.col("court") == "bge", F.regexp_replace(docket, r"^(?:CH)?(?:BGE|ATF|DTF)", "")).otherwise(docket)
    return F.concat_ws("|", F.coalesce(group, text("court")), docket, F.coalesce(compact_date("decision_date"), F.lit("")))


def covered_keys(df: DataFrame, least: int) -> DataFrame:
    """(key) of the decisions that some record has with a text of that length or more."""
    return df.where(F.length(text("full_text")) >= least).select(decision_key().alias("key")).distinct()


def worth_repair(short: DataFrame, df: DataFrame, least: int) -> DataFrame:
    """Records whose decision no other record has with a long text: the others would be dropped as duplicates anyway."""
    keyed = short.withColumn("key", decision_key())
    return keyed.join(covered_keys(df, least), "key", "left_anti").drop("key")


def changed_since(marks: DataFrame, sources: DataFrame) -> DataFrame:
    """Sources whose count or highest row differs from the mark (source, n, high) kept at the last run."""
    same = (F.col("m.n") == F.col("s.n")) & (F.col("m.high") == F.col("s.high"))
    return sources.alias("s").join(marks.alias("m"), F.col("m.source") == F.col("s.source"), "left").where(~F.coalesce(same, F.lit(False))).select("s.*")


def high_water(df: DataFrame, source: str, row: str) -> DataFrame:
    """(source, n, high): the mark to keep."""
    return df.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"), F.max(row).alias("high"))
