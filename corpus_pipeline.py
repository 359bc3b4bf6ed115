"""A corpus pipeline: each stage works on all that the one before it kept.

Toxic documents go, one document of each group of near duplicates stays, documents with a benchmark
passage go, personal data get pseudonyms, and what is left is tokenized. All stages but the last
return the columns of documents. Empty tables give empty results; rows with nulls are kept unless a
stage decides on their text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexbrook.llm import bpe, decontaminate, pii, simhash, toxicity
from lexbrook.llm.common import checkpointed, fold_crc, table
from lexbrook.llm.queries import tokenizer_file


def others(docs: DataFrame) -> list[str]:
    """The columns that operators carry along: all but the id and the text."""
    return [c for c in docs.columns if c not in ("doc_id", "text")]


def whole_again(docs: DataFrame, **new) -> list:
    """The columns of docs from an operator's result, some of them replaced."""
    own = {"doc_id": F.col("doc_id"), "text": F.col("text")} | new
    return [own.get(c, F.col(f"carry.`{c}`")).alias(c) for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the model learns from the labels of all folds but one."""
    model = toxicity.train(docs.where(fold_crc("doc_id", 5) != 0), table(spark, sf_dir, "labels").where(fold_crc("doc_id", 5) != 0))
    found = toxicity.score(docs, model, restored=False, carry=others(docs))
    return found.where("score < 0.5").select(*whole_again(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard of 0.8 or more of their five-word shingles: op3's index, cut for that likeness."""
    return simhash.representatives(docs, words=5, least=0.8)


#: Words of an item that a document must share in a row to be dropped; shorter items (a "yes") drop nothing.
FULL_WINDOW = 10


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a full window of any benchmark item."""
    items = table(spark, sf_dir, "benchmark").where(F.size(decontaminate.words_of(F.col("text"))) >= FULL_WINDOW)
    found = decontaminate.decontaminate(docs, items, carry=others(docs))
    return found.where("NOT contaminated").select(*whole_again(docs))


def pseudonymize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data in their texts."""
    found = pii.pseudonymize(docs, pii.session_key(spark), carry=others(docs))
    return found.select(*whole_again(docs, n_chars=F.length("text").cast("long")))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, digests of them and of the text that they decode to, and its other columns."""
    own = [c for c in others(docs) if c not in ("n_chars", "ids", "n_tokens", "ids_sha256", "decoded_sha256")]
    coded = bpe.bpe_encode(docs, tokenizer_file(), decoded=True, carry=own or None)
    return coded.select(
        "doc_id", *(F.col(f"carry.`{c}`").alias(c) for c in own), "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", pseudonymize),
    ("bpe", tokenize),
]

#: Toxicity, fingerprints, pseudonyms and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result made safe before the next begins."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else checkpointed(docs), sf_dir)
    return docs
