"""Dense and sparse vectors: nearest neighbours, inverted lists, chunks, encoders."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectorindex import VectorIndex

SPARSE_LEAST = 0.01


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a, b) -> Column:
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(0.0)


def nearest(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding", partition: str | None = None) -> DataFrame:
    """(query_id, id, similarity, rank): the k nearest of each query by cosine, ties by id, without an index.

    queries (query_id, query) is a table of any size; packs of its rows meet blocks of vectors, each pair of them once. ``partition``
    restricts a query to vectors with its value in that column. For many searches over the same vectors write a ``VectorIndex``.
    """
    return VectorIndex.build(vectors, id_col, vec_col, scope=partition, cells=1).search(queries, k, scope=partition)


def nearest_to(vectors: DataFrame, query: list[float], k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The k nearest of one query, by expressions alone."""
    q = F.array(*(F.lit(float(x)) for x in query))
    return vectors.select(F.col(id_col).alias("id"), cosine(F.col(vec_col), q).alias("similarity")).orderBy(F.desc("similarity"), "id").limit(k)


def sparse_terms(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = SPARSE_LEAST) -> DataFrame:
    """(id, token_id, weight): the weights of a vector above a least value."""
    return vectors.select(F.col(id_col).alias("id"), F.posexplode(vec_col).alias("token_id", "weight")).where(F.col("weight") > least).select("id", "token_id", F.col("weight").cast("double").alias("weight"))


def sparse_search(terms: DataFrame, query: DataFrame, k: int | None) -> DataFrame:
    """(id, score): the highest dot products with a query (token_id, w), best first; without k all of them, in no order."""
    found = terms.join(query, "token_id").groupBy("id").agg(F.sum(F.col("weight") * F.col("w")).alias("score"))
    return found if k is None else found.orderBy(F.desc("score"), "id").limit(k)


def best_chunk(chunks: DataFrame, query: list[float], k: int, doc_col: str, vec_col: str = "embedding") -> DataFrame:
    """Documents by the distance of their nearest chunk."""
    q = F.array(*(F.lit(float(x)) for x in query))
    return chunks.groupBy(F.col(doc_col).alias("doc")).agg(F.min(1 - cosine(F.col(vec_col), q)).alias("distance")).orderBy("distance", "doc").limit(k)


def hashing_encoder(dim: int = 64) -> Callable[[list[str]], np.ndarray]:
    """An encoder without a model, for tests: words hashed into signed places."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), np.float32)
        for i, t in enumerate(texts):
            for w in t.lower().split():
                h = xxhash.xxh64_intdigest(w)
                out[i, h % dim] += 1 if h >> 63 else -1
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(n > 0, n, 1)

    return encode


def encode(rows: DataFrame, encoder: Callable[[list[str]], np.ndarray], id_col: str = "decision_id", text_col: str = "text", batch: int = 64) -> DataFrame:
    """(id, embedding): each id once, rows without text left out. Texts of a batch go by length, so padding is small."""

    def run(batches: Iterator[pd.DataFrame]):
        for b in batches:
            b = b.sort_values("text", key=lambda s: s.str.len(), kind="stable")
            for i in range(0, len(b), batch):
                part = b.iloc[i : i + batch]
                yield pd.DataFrame({"id": part["id"], "embedding": [x.tolist() for x in encoder(part["text"].tolist())]})

    rows = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.length(F.coalesce("text", F.lit(""))) > 0).dropDuplicates(["id"])
    return rows.mapInPandas(run, f"id {rows.schema['id'].dataType.simpleString()}, embedding array<float>")
