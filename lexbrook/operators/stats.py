"""Corpus statistics: counts, ranges, growth, top lists; one aggregation each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import text
from .lineage import numbered

FIRST_DATE = "1800-01-01"


def valid_date(today: str | None = None) -> Column:
    d = F.col("decision_date")
    ok = d.isNotNull() & (d != "None") & (d > FIRST_DATE)
    return ok & (d <= today) if today else ok


def by_court(df: DataFrame, today: str) -> DataFrame:
    d = F.when(valid_date(today), F.col("decision_date"))
    return df.groupBy("court", "canton").agg(
        F.count("*").alias("n"), F.min(d).alias("earliest"), F.max(d).alias("latest"), F.max("scraped_at").alias("last_scraped"),
        F.array_join(F.array_sort(F.collect_set("language")), ",").alias("languages"),
    )


def by_canton(df: DataFrame, today: str) -> DataFrame:
    """Cantons with their courts, range and languages. The latest date has no lower bound, as in the figures it replaces."""
    d = F.col("decision_date")
    return df.where("canton <> 'CH'").groupBy("canton").agg(
        F.count("*").alias("n"), F.countDistinct("court").alias("courts"), F.min(F.when(valid_date(today), d)).alias("earliest"),
        F.max(F.when(d.isNotNull() & (d != "None") & (d <= today), d)).alias("latest"), F.array_join(F.array_sort(F.collect_set("language")), ",").alias("languages"),
    )


def counted(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def year_of(first: str = "1800", last: str = "2100") -> Column:
    y = F.substring("decision_date", 1, 4)
    return F.when(F.col("decision_date").isNotNull() & (F.col("decision_date") != "None") & (F.length("decision_date") >= 4) & y.between(first, last), y)


def by_year(df: DataFrame) -> DataFrame:
    return counted(df.withColumn("year", year_of()).where("year IS NOT NULL"), "year")


def language_by_year(df: DataFrame, first: str, last: str) -> DataFrame:
    return counted(df.withColumn("year", year_of(first, last)).where("year IS NOT NULL"), "year", "language")


def language_matrix(df: DataFrame, languages: list[str], *keys) -> DataFrame:
    """One column for each language."""
    return df.groupBy(*keys).agg(*(F.count(F.when(F.col("language") == x, 1)).alias(f"n_{x}") for x in languages))


def recent_days(df: DataFrame, today: str, days: int = 30) -> DataFrame:
    start = F.date_sub(F.lit(today).cast("date"), days).cast("string")
    return counted(df.where((F.col("decision_date") >= start) & (F.col("decision_date") <= today)).withColumnRenamed("decision_date", "day"), "day")


def by_month(df: DataFrame, today: str, years: int = 3) -> DataFrame:
    d = F.col("decision_date")
    start, end = F.add_months(F.lit(today).cast("date"), -12 * years).cast("string"), F.date_add(F.lit(today).cast("date"), 1).cast("string")
    return counted(df.where(d.isNotNull() & (d != "None") & (F.length(d) >= 7) & (d >= start) & (d < end)).withColumn("month", F.substring("decision_date", 1, 7)), "month")


def date_range(df: DataFrame, today: str) -> DataFrame:
    return df.where(valid_date(today)).agg(F.min("decision_date").alias("earliest"), F.max("decision_date").alias("latest"))


def federal_split(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.when(F.col("canton") == "CH", 1)).alias("federal"), F.count(F.when(F.col("canton") != "CH", 1)).alias("cantonal"))


def growth(counts: DataFrame, period: str = "year", n: str = "n") -> DataFrame:
    """Percentage growth against the period before it that is present. Counts of periods are few rows."""
    w = Window.orderBy(period)
    return counts.withColumn("before", F.lag(n).over(w)).where("before > 0").select(period, F.round((F.col(n) - F.col("before")) / F.col("before") * 100, 1).alias("growth"))


def top(df: DataFrame, k: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(k)


def latest_readable(df: DataFrame, today: str, k: int, courts: list[str]) -> DataFrame:
    """The newest decisions of some courts that have a text worth reading."""
    d = F.col("decision_date")
    rows = df.where(F.col("court").isin(courts) & d.isNotNull() & (d != "") & (d <= today) & (F.length("full_text") > 500) & ~F.col("full_text").ilike("%Document Dienstes ist fehlgeschlagen%"))
    return rows.orderBy(d.desc(), F.desc("decision_id")).limit(k)


def delta_to_earlier(snapshots: DataFrame, key: list[str], day: str, n: str) -> DataFrame:
    """Each day's count less that of the latest earlier day."""
    w = Window.partitionBy(*key).orderBy(day)
    return snapshots.withColumn("delta", F.col(n) - F.lag(n).over(w))


def page_of(df: DataFrame, order: list[Column], size: int) -> DataFrame:
    """Rows with their page and place, in a total order dealt out by ranges.

    Places come from the sizes of the ranges, so no task sees all rows.
    """
    place = numbered(df, "place", *order).withColumn("place", F.col("place") - 1)
    return place.withColumn("page", F.floor(F.col("place") / size))


def sitemap_chunks(df: DataFrame, size: int, *keys) -> DataFrame:
    """How many pages each group fills: n // size + 1, one row each."""
    n = counted(df, *keys).withColumn("chunks", F.floor(F.col("n") / size).cast("int") + 1)
    return n.select(*keys, "n", F.explode(F.sequence(F.lit(1), "chunks")).alias("chunk"))


def text_lengths(df: DataFrame, n: str = "text_length", *keys) -> DataFrame:
    c = F.col(n)
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(c).alias("mean"), F.count(F.when(c < 1000, 1)).alias("short"), F.count(F.when(c == 0, 1)).alias("empty"))


def length_histogram(df: DataFrame, n: str = "text_length") -> DataFrame:
    c = F.col(n)
    return df.agg(
        F.count("*").alias("total"), F.count(F.when(c == 0, 1)).alias("empty"), F.count(F.when((c > 0) & (c < 500), 1)).alias("stub"), F.count(F.when((c >= 500) & (c < 1000), 1)).alias("short"),
        F.count(F.when((c >= 1000) & (c < 3000), 1)).alias("thin"), F.count(F.when(c >= 3000, 1)).alias("normal"),
    )


def stub_samples(df: DataFrame, key: str, n: str = "text_length", id_col: str = "decision_id") -> DataFrame:
    """For each group its shortest row and its row of median length (place n // 2)."""
    w = Window.partitionBy(key)
    ranked = df.select(key, n, id_col).withColumn("_k", F.row_number().over(w.orderBy(n, id_col)) - 1).withColumn("_n", F.count("*").over(w))
    return ranked.groupBy(key).agg(F.min_by(id_col, "_k").alias("shortest"), F.max(F.when(F.col("_k") == F.floor(F.col("_n") / 2), F.col(id_col))).alias("median"))


def empty_share(df: DataFrame, key: str, value: str) -> DataFrame:
    """How many rows of each group have no value, and their share in per cent."""
    empty = F.count(F.when(F.length(F.trim(text(value))) == 0, 1))
    return df.groupBy(key).agg(empty.alias("empty"), F.count("*").alias("total")).where("empty > 0").withColumn("share", F.col("empty") * 100 / F.col("total"))
