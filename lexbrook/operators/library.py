"""Laws, commentaries and materials: joined with their laws, counted, and searched like decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import text
from . import search
from .index import Index

LAW_FIELDS = {"abbreviation": 2.0, "title": 6.0, "heading": 5.0, "text": 1.2}


def with_law(articles: DataFrame, laws: DataFrame, key: str = "abbreviation") -> DataFrame:
    """Articles with the law that their abbreviation names, whatever its case; an abbreviation of several laws means the one whose number sorts first."""
    once = laws.withColumn("_key", F.upper(F.trim(key))).groupBy("_key").agg(F.min(F.struct("sr_number", "title")).alias("_law"))
    return articles.withColumn("_key", F.upper(F.trim(key))).join(once, "_key", "left").select("*", F.col("_law.sr_number").alias("sr_number"), F.col("_law.title").alias("law_title")).drop("_key", "_law")


def article_of(articles: DataFrame, law: str, number: str) -> DataFrame:
    """One article of a law, by abbreviation or number of the law."""
    return articles.where(((F.upper("abbreviation") == law.upper()) | (F.col("sr_number") == law)) & (F.lower("article_num") == number.lower()))


def top_laws(articles: DataFrame, k: int = 20) -> DataFrame:
    """Laws by their number of articles; of several titles the one that sorts first."""
    return articles.groupBy("sr_number").agg(F.min("title").alias("title"), F.count("*").alias("articles")).orderBy(F.desc("articles"), "sr_number").limit(k)


def commentaries_by_law(commentaries: DataFrame) -> DataFrame:
    """Commentaries by law and language, with the first author by name."""
    return commentaries.groupBy("law", "language").agg(F.count("*").alias("n"), F.countDistinct("article_num").alias("articles"), F.min("author").alias("author"))


def amendments_by_kind(references: DataFrame) -> DataFrame:
    """References to amendments by the gazette that they name, with the years that they span."""
    return references.groupBy("kind").agg(F.count("*").alias("n"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def corpus_counts(tables: dict[str, DataFrame], canton: str = "canton") -> DataFrame:
    """(corpus, n, cantons) of several tables, each counted where it lies."""
    out = None
    for name, df in tables.items():
        cantons = F.countDistinct(F.nullif(text(canton), F.lit(""))) if canton in df.columns else F.lit(0).cast("long")
        one = df.agg(F.lit(name).alias("corpus"), F.count("*").alias("n"), cantons.alias("cantons"))
        out = one if out is None else out.unionByName(one)
    return out


def search_table(df: DataFrame, query: str, fields: dict[str, float], id_col: str, limit: int = 20, filters=None, index: Index | None = None) -> DataFrame:
    """Any table of texts searched as decisions are: commentaries, materials, debates."""
    found = search.search(df, query, fields, filters, limit, 0, id_col, index)
    return df.join(F.broadcast(found.withColumnRenamed("doc", id_col)), id_col).orderBy(F.desc("score"), id_col)  # limit rows


def search_laws(federal: DataFrame, cantonal: DataFrame, query: str, limit: int = 20, canton: str | None = None, jurisdiction: str | None = None, id_col: str = "article_id") -> DataFrame:
    """Two bodies of law, each ranked by itself, in turns; jurisdiction: federal or cantonal, else both."""
    own = None if canton is None else F.col("canton") == canton.upper()
    fields = lambda df: {f: w for f, w in LAW_FIELDS.items() if f in df.columns}
    a = search.search(federal, query, fields(federal), None, limit, 0, id_col) if jurisdiction != "cantonal" else None
    b = search.search(cantonal, query, fields(cantonal), own, limit, 0, id_col) if jurisdiction != "federal" else None
    if a is None or b is None:
        return search.ranked(b if a is None else a).orderBy("rank")
    return search.interleave(a, b, limit)


def merged_statutes(explicit: DataFrame, extracted: DataFrame) -> DataFrame:
    """(decision_id, statute_id): references that were given and those found in the text, each once."""
    names = ["decision_id", "statute_id"]
    return explicit.select(*names).unionByName(extracted.select(*names)).distinct()


def brief_statutes(paragraphs: DataFrame, refs: str = "statutes", body: str = "text") -> DataFrame:
    """(decision_id, statutes, excerpts): sorted distinct statutes of all paragraphs, and the paragraphs' beginnings: 500 characters, 1000 of the first."""
    first = F.when(F.col("position") == 0, 1000).otherwise(500)
    cut = paragraphs.withColumn("_x", F.col(body).substr(F.lit(1), first))
    return cut.groupBy("decision_id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(refs)))).alias("statutes"), F.transform(F.array_sort(F.collect_list(F.struct("position", "_x"))), lambda p: p["_x"]).alias("excerpts")
    )
