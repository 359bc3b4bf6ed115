"""Data quality: anomalies, gates, duplicate reports and enrichment of missing fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import content_hash, date_from_docket, date_from_text, is_missing_date, strip, text

LANGUAGES = ["de", "fr", "it", "rm"]


def _flags(limit: str) -> dict[str, Column]:
    d = F.col("decision_date")
    present = d.isNotNull() & (d != "") & (d != "None")
    return {
        "null_or_empty": is_missing_date("decision_date"), "future": F.coalesce(d > limit, F.lit(False)),
        "pre_1800": F.coalesce(present & (d < "1800-01-01"), F.lit(False)), "invalid_format": F.coalesce(present & (F.length(d) < 10), F.lit(False)),
    }


def short_text() -> Column:
    return F.length(text("full_text")) < 50


def placeholder_text() -> Column:
    return F.coalesce(F.col("full_text").ilike("%[Text extraction failed%") | F.col("full_text").ilike("%(metadata only)%"), F.lit(False))


def date_report(df: DataFrame, limit: str) -> DataFrame:
    """Counts of each anomaly and of rows with any; limit: the day after which a date is in the future."""
    flags = _flags(limit)
    any_bad = flags["null_or_empty"] | flags["future"] | flags["pre_1800"] | flags["invalid_format"]
    out = df.agg(F.count("*").alias("total"), *(F.count(F.when(c, 1)).alias(k) for k, c in flags.items()), F.count(F.when(any_bad, 1)).alias("anomalies"))
    return out.withColumn("anomaly_pct", F.round(F.col("anomalies") / F.col("total") * 100, 3))


def text_report(df: DataFrame) -> DataFrame:
    """Short and placeholder texts; their plain sum may count a row twice, as in the figures it replaces."""
    out = df.agg(F.count("*").alias("total"), F.count(F.when(short_text(), 1)).alias("short"), F.count(F.when(placeholder_text(), 1)).alias("placeholder"))
    return out.withColumn("missing", F.col("short") + F.col("placeholder")).withColumn("missing_pct", F.round(F.col("missing") / F.col("total") * 100, 3))


def language_report(df: DataFrame) -> DataFrame:
    return df.groupBy("language").agg(F.count("*").alias("n")).withColumn("unexpected", ~F.coalesce(F.col("language").isin(LANGUAGES), F.lit(False)))


def court_report(df: DataFrame, limit: str) -> DataFrame:
    flags = _flags(limit)
    d = F.col("decision_date")
    out = df.groupBy("court", "canton").agg(
        F.count("*").alias("total"), F.count(F.when(flags["null_or_empty"], 1)).alias("date_missing"), F.count(F.when(short_text(), 1)).alias("text_missing"),
        F.count(F.when(flags["future"], 1)).alias("date_future"), F.min(F.when((d != "None") & (d > "1800-01-01"), d)).alias("earliest"), F.max(F.when((d != "None") & (d < "2100-01-01"), d)).alias("latest"),
    )
    return out.withColumn("quality_score", F.round((1 - (F.col("date_missing") + F.col("text_missing")) / F.col("total")) * 100, 1))


def overall_score(df: DataFrame, limit: str) -> DataFrame:
    """The mean of date and text quality, in per cent."""
    both = date_report(df, limit).select("anomaly_pct").crossJoin(text_report(df).select("missing_pct"))  # one row each
    return both.select(F.round(((1 - F.col("anomaly_pct") / 100) * 0.5 + (1 - F.col("missing_pct") / 100) * 0.5) * 100, 1).alias("score"))


def failed_gates(df: DataFrame, limit: str, max_date_pct: float, max_text_pct: float) -> list[str]:
    dates, texts = date_report(df, limit).first(), text_report(df).first()
    out = []
    if (dates["anomaly_pct"] or 0) > max_date_pct:
        out.append(f"date anomalies {dates['anomaly_pct']} % above {max_date_pct} %")
    if (texts["missing_pct"] or 0) > max_text_pct:
        out.append(f"missing texts {texts['missing_pct']} % above {max_text_pct} %")
    return out


def duplicate_groups(df: DataFrame, *keys) -> DataFrame:
    """Keys that more than one row has, with their rows' ids in one text: for reports, where groups are small. Where a key may have a
    large share of all rows, ``duplicate_members`` says the same without a list."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("decision_id")), "|").alias("ids")).where("n > 1")


def duplicate_counts(df: DataFrame, *keys) -> DataFrame:
    """Keys that more than one row has; counted before rows meet, so a common key does no harm."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_members(df: DataFrame, *keys) -> DataFrame:
    """(keys, decision_id, representative) of each row that shares its key; the representative is the least id. Null keys are shared like others."""
    least = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("decision_id").alias("representative")).where("_n > 1").drop("_n")
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"g.{k}")) for k in keys]
    return df.alias("d").join(least.alias("g"), same).select(*(F.col(f"d.{k}") for k in keys), "d.decision_id", "g.representative")


def count_of_duplicate_groups(df: DataFrame, *keys) -> DataFrame:
    """(groups, rows): how many keys are there more than once, and how many rows they have; counts only, no lists."""
    per = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return per.agg(F.count("*").alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))


def content_duplicates(df: DataFrame) -> DataFrame:
    hashed = df.where(F.length(text("full_text")) > 0).withColumn("hash", content_hash("full_text"))
    return hashed.groupBy("hash").agg(F.count("*").alias("n"), F.min("decision_id").alias("first_id")).where("n > 1")


def duplicates_by_court(groups: DataFrame) -> DataFrame:
    """How many rows are superfluous in each court."""
    return groups.groupBy("court").agg(F.count("*").alias("groups"), F.sum(F.col("n") - 1).alias("superfluous"))


def artefacts(df: DataFrame, c: str = "full_text") -> DataFrame:
    """Rows with remains of markup or of a wrong encoding; patterns ignore case as the store did."""
    #: The patterns, by class.
    classes = {"br": ["%<br%"], "blocks": ["%<p>%", "%<div>%"], "nbsp": ["%&nbsp;%"], "ae": ["%Ã¤%"], "oe": ["%Ã¶%"], "ue": ["%Ã¼%"], "section": ["%Â§%"]}
    out = []
    for k, patterns in classes.items():
        hit = F.lit(False)
        for p in patterns:
            hit |= F.coalesce(F.col(c).ilike(p), F.lit(False))
        out.append(F.count(F.when(hit, 1)).alias(k))
    return df.agg(*out)


def quality_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total"), F.count(F.when(F.length(text("full_text")) < 500, 1)).alias("short"), F.count(F.when(F.length(F.trim(text("regeste"))) == 0, 1)).alias("no_regeste"),
        F.count(F.when(F.length(F.trim(text("decision_date"))) == 0, 1)).alias("no_date"),
    )


#: Where a headnote starts and what ends it.
REGESTE_START = r"(?i)(?:^|\n)\s*Regeste\b[:\s]*\n"
REGESTE_END = r"(?m)^(?:\s*(?i:Sachverhalt|Faits|Fatti|Urteilskopf)\b|\s*A\.\s)"
TITLE_LABEL = r"(?:Gegenstand|Objet(?:\s+du\s+recours)?|Oggetto)\s*:?\s*"
TITLES = [rf"(?is){TITLE_LABEL}\n?\s*(.*?)(?:\n\s*\n|Beschwerde|Recours|Ricorso|Sachverhalt|Faits|Fatti)", rf"(?i){TITLE_LABEL}(.*?)(?:\n|;)"]
SHORT_REGESTE = r"(?s)(?:Regeste|Regesto)\s*(?:\([^)]*\))?\s*:?\s*\n(.*?)(?:\nSachverhalt|\nFaits|\nFatti|\nAus den Erwägungen|\nConsidérant en droit|\nExtrait|\nA\.\s)"


def regeste_from_text(c) -> Column:
    """The block under a headnote's heading, up to the next section; 20 to 5000 characters."""
    t = text(c)
    after = F.when(t.rlike(REGESTE_START), F.get(F.split(t, REGESTE_START, 2), F.lit(1)))
    body = strip(F.get(F.split(after, REGESTE_END, 2), F.lit(0)))
    return F.when(F.length(body).between(20, 5000), body)


def short_regeste_from_text(c) -> Column:
    body = strip(F.regexp_extract(F.substring(text(c), 1, 5000), SHORT_REGESTE, 1))
    return F.when((F.length(body) > 50) & (F.length(body) < 3000), body)


def title_from_text(c) -> Column:
    head = F.substring(text(c), 1, 2000)
    found = [F.regexp_replace(strip(F.regexp_extract(head, p, 1)), r"\s+", " ") for p in TITLES]
    return F.coalesce(*(F.when((F.length(x) > 10) & (F.length(x) < 500), x) for x in found))


def with_regeste(df: DataFrame, courts: list[str] = ("bger", "bge")) -> DataFrame:
    """Missing headnotes of some courts, taken from texts of more than 200 characters."""
    missing = F.col("court").isin(list(courts)) & (F.length(F.trim(text("regeste"))) == 0) & (F.length(text("full_text")) > 200)
    return df.withColumn("regeste", F.when(missing, F.coalesce(regeste_from_text("full_text"), F.col("regeste"))).otherwise(F.col("regeste")))


def with_short_regeste(df: DataFrame) -> DataFrame:
    return df.withColumn("regeste", F.when(F.length(F.trim(text("regeste"))) == 0, F.coalesce(short_regeste_from_text("full_text"), F.col("regeste"))).otherwise(F.col("regeste")))


def with_title(df: DataFrame) -> DataFrame:
    return df.withColumn("title", F.when(F.length(F.trim(text("title"))) == 0, F.coalesce(title_from_text("full_text"), F.col("title"))).otherwise(F.col("title")))


def with_repaired_date(df: DataFrame) -> DataFrame:
    """Missing dates from the docket's year, else from the text. Keys are left as they are."""
    d = F.col("decision_date")
    missing = is_missing_date("decision_date") | (d == "0000-00-00")
    return df.withColumn("decision_date", F.when(missing, F.coalesce(date_from_docket("docket_number"), date_from_text("full_text"), d)).otherwise(d))


def with_content_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("content_hash", F.when(F.length(text("content_hash")) > 0, F.col("content_hash")).otherwise(content_hash("full_text")))


def violations(df: DataFrame) -> DataFrame:
    """(decision_id, rule) for each rule that a record breaks."""
    rules = {
        "no_id": text("decision_id") == "", "no_court": text("court") == "", "no_docket": text("docket_number") == "", "language": ~F.coalesce(F.col("language").isin(LANGUAGES), F.lit(False)),
        "date": ~is_missing_date("decision_date") & F.col("decision_date").try_cast("date").isNull(),
    }
    broken = F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items())))
    return df.select("decision_id", F.explode(broken).alias("rule"))
