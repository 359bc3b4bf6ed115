"""The query of each operator, over whole tables, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, convtrie, decontaminate, html, langid, licenses, lmscore, pii, quality, resampling, simhash, spotsigs, toxicity
from .common import fold_crc, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document, decode the ids again, and give digests of both."""
    docs = table(spark, sf_dir, "documents")
    coded = bpe.bpe_encode(docs, tokenizer_file(), decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the folds that are not held out."""
    docs = table(spark, sf_dir, "documents")
    train = docs.where((fold_crc("doc_id", 5) != 0) & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    found = langid.identify(docs.select("doc_id", "text"), langid.train_dictionaries(train))
    return found.select(
        "doc_id", (F.coalesce(fold_crc("doc_id", 5), F.lit(-1)) == 0).alias("held_out"), F.col("lang").alias("lang_pred"), "score", "margin", "rejected"
    )


@query
def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = html.extract_main_text(table(spark, sf_dir, "pages"), carry=["url"])
    return found.select("page_id", "carry.url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document that is a licence text, and the one-line notices within others."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "digest", "license_id", F.array_join("notices", ",").alias("notices"))


ORACLES["op7_licenses"] = licenses.oracle()


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by pseudonyms of the same form, under the session's key."""
    found = pii.pseudonymize(table(spark, sf_dir, "documents"), pii.session_key(spark))
    return found.select(
        "doc_id", "text", F.size("spans").cast("long").alias("n_replaced"), F.array_join(F.transform("spans", lambda x: x["kind"]), ",").alias("kinds"),
        F.to_json("spans").alias("spans"),
    )


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every document and the least id of those that it is linked to."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return spotsigs.edit_likeness(table(spark, sf_dir, "documents"))


@query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item."""
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


ORACLES["op6_decontaminate"] = decontaminate.oracle()


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of the folds that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs.where(fold_crc("doc_id", 5) != 0), table(spark, sf_dir, "labels").where(fold_crc("doc_id", 5) != 0))
    found = toxicity.score(docs, model, restored=False)
    return found.select(
        "doc_id", (F.coalesce(fold_crc("doc_id", 5), F.lit(-1)) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_restored"
    )


@query
def op5_lmscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document, learned from the folds that are not held out; null ids have no fold and teach nothing."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = lmscore.score(docs, docs.where(fold_crc("doc_id", 7) != 2))
    return found.select("doc_id", (F.coalesce(fold_crc("doc_id", 7), F.lit(-1)) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight by the words of the benchmark, and the rank of the tenth that is drawn."""
    found = resampling.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


ORACLES["op11_resampling"] = resampling.oracle()


@query
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels of the folds that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs.where(fold_crc("doc_id", 4) != 2), table(spark, sf_dir, "labels").where(fold_crc("doc_id", 4) != 2))
    found = quality.score(docs, model)
    return found.select("doc_id", (F.coalesce(fold_crc("doc_id", 4), F.lit(-1)) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op13_convtrie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt so that those of a family begin alike."""
    return convtrie.trie(*convtrie.rebuilt(convtrie.coded(table(spark, sf_dir, "conversations"))))


ORACLES["op13_convtrie"] = convtrie.oracle()
