"""Finding the decisions that dockets, references and ids of other systems stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.references import docket_candidates
from ..functions.text import col, report_reference, text, tokens
from . import search
from .index import Index
from .lineage import checkpointed

#: Forms of dockets and reports that tag lists name.
TAG_DOCKETS = [r"\b\d[A-Z]_\d+/\d{4}\b", r"\b\d[A-Z]\.\d+/\d{4}\b"]
TAG_REPORT = r"\b(?:BGE|ATF|DTF)\s+\d{2,3}\s+[A-Z]+\s+\d+"
REPORT_NAME = r"^(?:BGE|ATF|DTF)\s+"
LEAST_HEADNOTE, QUERY_CHARS = 50, 100


def plain_docket(c) -> Column:
    return F.regexp_replace(F.lower(text(c)), "[^0-9a-z]", "")


def first_of(df: DataFrame, key: str) -> DataFrame:
    """(key, decision_id): of several decisions with a key the one whose id sorts first."""
    return df.where(F.col(key) != "").groupBy(key).agg(F.min("decision_id").alias("decision_id"))


def dockets_in(c) -> Column:
    """Sorted distinct dockets and reports of a text, as written."""
    return F.array_sort(F.array_distinct(F.concat(*(F.regexp_extract_all(text(c), F.lit(p), 0) for p in (*TAG_DOCKETS, TAG_REPORT)))))


def resolved_dockets(refs: DataFrame, decisions: DataFrame, ref: str = "docket") -> DataFrame:
    """refs with decision_id: dockets by equality; reports by the beginning of the id (bge_volume_division_page), pages as whole numbers."""
    c = F.col(ref)
    report = F.concat(F.lit("bge_"), F.regexp_replace(F.trim(F.regexp_replace(c, REPORT_NAME, "")), r"\s+", "_"))
    keyed = refs.withColumn("_key", F.when(c.rlike(REPORT_NAME), report).otherwise(c))
    own = F.array(text("docket_number"), F.regexp_extract("decision_id", r"^(bge_\d+_[A-Z]+_\d+)(?!\d)", 1))
    known = first_of(decisions.select("decision_id", F.explode(own).alias("_key")), "_key")
    return keyed.join(known, "_key", "left").drop("_key")


def tags(lists: DataFrame, decisions: DataFrame, label: str = "label", body: str = "text") -> DataFrame:
    """(decision_id, label): each decision that a list's text names, once a label; names that nothing resolves are left out."""
    named = lists.select(F.col(label).alias("label"), F.explode(dockets_in(body)).alias("docket"))
    return resolved_dockets(named, decisions).where("decision_id IS NOT NULL").select("decision_id", "label").distinct()


def article_label(file_name) -> Column:
    """'Art. 12' of a file named Art12.pdf."""
    n = F.regexp_extract(text(file_name), r"[Aa]rt(\d+)", 1)
    return F.when(n != "", F.concat(F.lit("Art. "), n))


def by_docket(refs: DataFrame, decisions: DataFrame, ref: str = "docket") -> DataFrame:
    """refs with decision_id: by the docket as written, else by its letters and digits alone."""
    exact = first_of(decisions.select("decision_id", text("docket_number").alias("_exact")), "_exact").withColumnRenamed("decision_id", "_id1")
    loose = first_of(decisions.select("decision_id", plain_docket("docket_number").alias("_loose")), "_loose").withColumnRenamed("decision_id", "_id2")
    keyed = refs.withColumn("_exact", F.col(ref)).withColumn("_loose", plain_docket(ref))
    return keyed.join(exact, "_exact", "left").join(loose, "_loose", "left").withColumn("decision_id", F.coalesce("_id1", "_id2")).drop("_exact", "_loose", "_id1", "_id2")


def relevant_ids(wanted: DataFrame, decisions: DataFrame, ref: str = "relevant_id") -> DataFrame:
    """(relevant_id, decision_id): an id that is there stands for itself; else its likeliest docket that is found."""
    ids = wanted.select(F.col(ref).alias("relevant_id")).distinct()
    there = decisions.select(F.col("decision_id").alias("relevant_id")).distinct().withColumn("_there", F.lit(True))
    marked = ids.join(there, "relevant_id", "left")
    tries = marked.where("_there IS NULL").select("relevant_id", F.posexplode(docket_candidates("relevant_id")).alias("k", "docket"))
    found = by_docket(tries, decisions).where("decision_id IS NOT NULL").groupBy("relevant_id").agg(F.min_by("decision_id", "k").alias("_found"))
    return marked.join(found, "relevant_id", "left").select("relevant_id", F.when(F.col("_there"), F.col("relevant_id")).otherwise(F.col("_found")).alias("decision_id"))


def curriculum_ids(cases: DataFrame, decisions: DataFrame, ref: str = "bge_ref") -> DataFrame:
    """cases with the decision of the report that they name, whatever the spelling of its docket."""
    a, b = report_reference(ref), report_reference("docket_number")
    key = lambda r: F.when(r["volume"].isNotNull(), F.concat_ws(" ", r["volume"], r["division"], r["page"]))
    known = decisions.withColumn("_key", key(b)).where("_key IS NOT NULL").groupBy("_key").agg(F.min("decision_id").alias("decision_id"))
    return cases.withColumn("_key", key(a)).join(known, "_key", "left").drop("_key")


def scanned(refs: DataFrame, decisions: DataFrame, doc: str = "doc", ref: str = "ref") -> DataFrame:
    """(doc, ref, decision_id, found, has_text): each distinct reference of a document against dockets, white space aside."""
    squeezed = lambda c: F.regexp_replace(F.upper(F.trim(c)), r"\s+", " ")
    long = decisions.select("decision_id", squeezed(text("docket_number")).alias("_key"), (F.length(F.trim(text("full_text"))) > 0).alias("_text"))
    known = long.groupBy("_key").agg(F.min("decision_id").alias("decision_id"), F.max("_text").alias("_text"))
    once = refs.select(F.col(doc).alias("doc"), F.col(ref).alias("ref")).distinct().withColumn("_key", squeezed(F.col("ref")))
    return once.join(known, "_key", "left").select("doc", "ref", "decision_id", F.col("decision_id").isNotNull().alias("found"), F.coalesce("_text", F.lit(False)).alias("has_text"))


def headnote_pairs(targets: DataFrame, decisions: DataFrame) -> DataFrame:
    """(query, target_id, source_id): headnotes of citing decisions, where both ends have one of some length."""
    notes = decisions.where(F.length(text("regeste")) >= LEAST_HEADNOTE).select("decision_id", F.substring("regeste", 1, 200).alias("note"))
    s = notes.select(F.col("decision_id").alias("source_id"), F.col("note").alias("query"))
    t = notes.select(F.col("decision_id").alias("target_id"))
    links = targets.select(F.col("source_decision_id").alias("source_id"), F.col("target_decision_id").alias("target_id")).distinct()
    return links.join(s, "source_id").join(t, "target_id").select("query", "target_id", "source_id")


def retrieval_check(index: Index, pairs: DataFrame, fields: dict[str, float], k: int = 10) -> DataFrame:
    """(pairs, hits, hit_rate, mrr): whether the target is among the k best for the words of a headnote's beginning; all pairs at once."""
    asked = pairs.select("source_id", F.explode(F.array_distinct(tokens(F.substring("query", 1, QUERY_CHARS)))).alias("term")).distinct()
    both = pairs.select(F.col("source_id").alias("query_id"), F.col("target_id").alias("doc")).distinct()
    best = search.placed(index, checkpointed(asked.select(F.col("source_id").alias("query_id"), "term")), both, fields, k)
    hit = pairs.join(best.select(F.col("query_id").alias("source_id"), F.col("doc").alias("target_id"), "rank"), ["source_id", "target_id"], "left")
    return hit.agg(F.count("*").alias("pairs"), F.count("rank").alias("hits"), F.round(F.count("rank") / F.count("*"), 4).alias("hit_rate"), F.round(F.coalesce(F.avg(F.coalesce(1 / F.col("rank"), F.lit(0.0))), F.lit(0.0)), 4).alias("mrr"))
