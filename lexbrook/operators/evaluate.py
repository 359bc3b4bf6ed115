"""Retrieval quality: reciprocal rank, recall, hits and three definitions of nDCG, by expressions over results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lineage import running


def judged(results: DataFrame, judgments: DataFrame, k: int) -> DataFrame:
    """Results (query_id, doc, rank) down to k with the highest grade (query_id, doc, grade) of each, 0 if none."""
    best = judgments.groupBy("query_id", "doc").agg(F.max("grade").alias("grade"))
    return results.where(F.col("rank") <= k).join(best, ["query_id", "doc"], "left").withColumn("grade", F.coalesce("grade", F.lit(0)))


def ideal(judgments: DataFrame, k: int, linear: bool = False) -> DataFrame:
    """(query_id, relevant, idcg) from the highest grades."""
    best = judgments.groupBy("query_id", "doc").agg(F.max("grade").alias("grade")).where("grade > 0")
    placed = best.withColumn("i", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("grade"), "doc")))
    gain = F.col("grade").cast("double") if linear else F.pow(F.lit(2.0), F.col("grade")) - 1
    return placed.groupBy("query_id").agg(F.count("*").alias("relevant"), F.sum(F.when(F.col("i") <= k, gain / F.log2(F.col("i") + 1.0))).alias("idcg"))


def per_query(results: DataFrame, judgments: DataFrame, k: int = 10) -> DataFrame:
    """rr, recall, hit1, ndcg_compressed, ndcg and ndcg_linear of each query that has a relevant document.

    ndcg_compressed: exponential gain with the gaps between found documents closed; ndcg: by true
    ranks; ndcg_linear: grades as gains. They must not be compared with each other.
    """
    hits = judged(results, judgments, k)
    found = hits.where("grade > 0").withColumn("i", F.row_number().over(Window.partitionBy("query_id").orderBy("rank")))
    gain = F.pow(F.lit(2.0), F.col("grade")) - 1
    per = found.groupBy("query_id").agg(
        (1 / F.min("rank")).alias("rr"), F.count("*").alias("n"), F.max(F.when(F.col("rank") == 1, 1.0).otherwise(0.0)).alias("hit1"),
        F.sum(gain / F.log2(F.col("i") + 1.0)).alias("a"), F.sum(gain / F.log2(F.col("rank") + 1.0)).alias("b"), F.sum(F.col("grade") / F.log2(F.col("rank") + 1.0)).alias("c"),
    )
    best = ideal(judgments, k).join(ideal(judgments, k, True).select("query_id", F.col("idcg").alias("linear")), "query_id")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return best.join(per, "query_id", "left").select(
        "query_id", zero("rr").alias("rr"), (F.coalesce("n", F.lit(0)) / F.col("relevant")).alias("recall"), zero("hit1").alias("hit1"),
        zero(F.col("a") / F.col("idcg")).alias("ndcg_compressed"), zero(F.col("b") / F.col("idcg")).alias("ndcg"), zero(F.col("c") / F.col("linear")).alias("ndcg_linear"),
    )


def summary(per: DataFrame, *keys) -> DataFrame:
    return per.groupBy(*keys).agg(F.count("*").alias("queries"), *(F.avg(c).alias(c) for c in ("rr", "recall", "hit1", "ndcg_compressed", "ndcg", "ndcg_linear")))


def by_tag(per: DataFrame, queries: DataFrame) -> DataFrame:
    """The same for each tag of the queries (query_id, tags)."""
    return summary(per.join(queries.select("query_id", F.explode("tags").alias("tag")), "query_id"), "tag")


def latency(rows: DataFrame, value: str = "latency_ms") -> DataFrame:
    """Mean and 95th percentile as the element at int(0.95 n) - 1 of the sorted values; found among the counts of equal values,
    which are dealt out by ranges."""
    v = F.col(value).cast("double")
    counts = rows.where(v.isNotNull()).groupBy(v.alias("v")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("n"), (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("mean")).first()
    wanted = max(int(0.95 * (total["n"] or 0)), 1)
    upto = running(counts, "_upto", "n", F.asc("v"))
    return upto.where(F.col("_upto") >= wanted).agg(F.lit(total["mean"]).cast("double").alias("mean"), F.min("v").alias("p95"))


def merged_goldens(sets: list[DataFrame]) -> DataFrame:
    """Several sets of queries (id, ...) in one; an id that is taken gets __2, __3 and so on."""
    from .dedup import union_all

    rows = union_all([s.withColumn("_set", F.lit(i)) for i, s in enumerate(sets)])
    k = F.row_number().over(Window.partitionBy("id").orderBy("_set"))
    return rows.withColumn("_k", k).withColumn("id", F.when(F.col("_k") > 1, F.concat("id", F.lit("__"), F.col("_k").cast("string"))).otherwise(F.col("id"))).drop("_k", "_set")


def tag_gates(queries: DataFrame, least: dict[str, int]) -> list[str]:
    """The tags that fewer queries have than asked for."""
    counts = {r["tag"]: r["count"] for r in queries.select(F.explode("tags").alias("tag")).groupBy("tag").count().where(F.col("tag").isin(list(least))).collect()}
    return [f"{t}: {counts.get(t, 0)} of {n}" for t, n in least.items() if counts.get(t, 0) < n]


def sampled_pairs(pairs: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n pairs in an order that a seed gives."""
    return pairs.orderBy(F.xxhash64(F.lit(seed), *pairs.columns), *pairs.columns).limit(n)


def profile_difference(a: DataFrame, b: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Counts of two releases side by side."""
    return a.select(key, F.col(n).alias("n_a")).join(b.select(key, F.col(n).alias("n_b")), key, "full_outer").select(key, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_a", "n_b"))).withColumn("difference", F.col("n_b") - F.col("n_a"))


def converged(scores: list[float], window: int = 3, within: float = 0.002) -> bool:
    return len(scores) >= window and max(scores[-window:]) - min(scores[-window:]) <= within


def hill_climb(score, start: dict[str, float], moves, rounds: int = 20) -> tuple[dict[str, float], list[float]]:
    """Improve a configuration by trying moves(config, round) and keeping what scores higher, until scores settle."""
    best, at = dict(start), score(start)
    history = [at]
    for i in range(rounds):
        trial = moves(best, i)
        if (s := score(trial)) > at:
            best, at = trial, s
        history.append(at)
        if converged(history, 3) and i >= 3:
            break
    return best, history


def worst(per: DataFrame, n: int) -> DataFrame:
    """The n queries with the least reciprocal rank, equals by id."""
    return per.orderBy("rr", "query_id").limit(n)
