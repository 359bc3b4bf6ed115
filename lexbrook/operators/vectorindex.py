"""Nearest neighbours through an inverted file: vectors lie by the cell of their nearest centroid, and a query reads few cells.

Centroids are fitted on a bounded sample (``SAMPLE`` vectors, chosen by hash of their ids) and are at most ``MOST_CELLS``, so they are
a small table that may be broadcast; every vector is indexed. A cell is written as blocks of about ``BLOCK`` vectors, so a
crowded cell is many rows. Queries are a table, too: each row is sent to the cells to be looked at, packed there
with others, and met with the cell's blocks one by one, as a product of two matrices.

A search by ``probes`` cells may miss neighbours; ``probes_for`` finds on a bounded sample of the index's own vectors how many cells
a wanted recall takes. An exact search goes on: with the k-th best
similarity s found so far, a cell whose centroid is at angle a to the query and whose vectors are within angle r of the
centroid can hold nothing better than cos(a - r), so only the cells with cos(a - r) >= s are read beside the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .lineage import checkpointed

SAMPLE, MOST_CELLS, BLOCK, QUERIES = 20_000, 4096, 1024, 512
#: The cell of vectors of length 0, which are equally far from all; it is always read.
NOWHERE = -1
CELL = "cell int, centroid array<double>, radius double, n long, parts int"


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def matrix(lists: pa.Array) -> np.ndarray:
    """The rows of an Arrow array of lists of one length."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 1)


def centroids_of(x: np.ndarray, cells: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit vectors by spherical k-means; an empty cell takes the vector that its centroid fits least."""
    if len(x) <= cells:
        return np.unique(x, axis=0) if len(x) else x
    c = x[np.random.default_rng(seed).choice(len(x), cells, replace=False)]
    for _ in range(rounds):
        best, fit = nearest_cells(x, c)
        sums = np.zeros_like(c)
        np.add.at(sums, best, x)
        empty = np.flatnonzero(np.bincount(best, minlength=len(c)) == 0)
        sums[empty] = x[np.argsort(fit)[: len(empty)]]
        c = unit(sums)
    return c


def nearest_cells(x: np.ndarray, c: np.ndarray, step: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the centroid with the highest product, and that product."""
    best, fit = np.zeros(len(x), np.int64), np.zeros(len(x))
    for i in range(0, len(x), step):
        s = x[i : i + step] @ c.T
        best[i : i + step] = s.argmax(1)
        fit[i : i + step] = s.max(1)
    return best, fit


def packed(rows: DataFrame, sizes: DataFrame, size: int, *columns: str) -> DataFrame:
    """rows (cell, scope, columns) as groups of about ``size`` at most: (cell, scope, part, members); sizes: (cell, n), MOST_CELLS rows at most."""
    parts = sizes.select("cell", F.ceil(F.col("n") / size).cast("int").alias("_parts"))
    dealt = rows.join(F.broadcast(parts), "cell").withColumn("part", F.pmod(F.xxhash64(columns[0]), F.col("_parts")).cast("int"))
    return dealt.groupBy("cell", "scope", "part").agg(F.collect_list(F.struct(*columns)).alias("members"))


def best_of_blocks(met: DataFrame, k: int, id_kind: str, query_kind: str) -> DataFrame:
    """(query_id, id, similarity, cell): from rows (cell, members, asked) the k best of each query within each block, all that tie included."""

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for i in range(b.num_rows):
                members, asked = b.column("members")[i].values, b.column("asked")[i].values
                s = unit(matrix(asked.field("query"))) @ unit(matrix(members.field("vector"))).T
                if s.shape[1] > k:
                    edge = np.partition(s, s.shape[1] - k, axis=1)[:, -k]
                    q, v = np.nonzero(s >= edge[:, None])
                else:
                    q, v = (x.ravel() for x in np.indices(s.shape))
                yield pa.record_batch([asked.field("query_id").take(pa.array(q)), members.field("id").take(pa.array(v)), pa.array(s[q, v]), b.column("cell").take(pa.array(np.full(len(q), i)))], names=["query_id", "id", "similarity", "cell"])

    return met.select("cell", "members", "asked").mapInArrow(run, f"query_id {query_kind}, id {id_kind}, similarity double, cell int")


class VectorIndex:
    """Blocks (cell, scope, part, members) and cells (CELL). ``scope`` is a column that queries may be held to, if one was named."""

    def __init__(self, cells: DataFrame, blocks: DataFrame):
        self.cells, self.blocks = cells, blocks

    @classmethod
    def build(cls, vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scope: str | None = None, cells: int | None = None, sample: int = SAMPLE) -> VectorIndex:
        """An index of all rows of vectors with an id and a vector; about sqrt(n) cells unless told otherwise."""
        at = F.col(scope) if scope else F.lit(0)
        rows = vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vector"), at.alias("scope"))
        n = rows.count()
        cells = min(MOST_CELLS, cells or max(1, int(n**0.5)))
        if cells == 1:
            c = np.zeros((0, 1))
        else:
            h = F.pmod(F.xxhash64("id"), F.lit(1 << 31))
            some = rows.where(h < (1 << 31) * min(1.0, 1.2 * sample / max(1, n))).orderBy(h, "id").limit(sample).select("vector").toArrow()
            x = matrix(some.column(0).combine_chunks())
            c = centroids_of(unit(x[np.linalg.norm(x, axis=1) > 0]), cells)
        sent = rows.sparkSession.sparkContext.broadcast(c)  # MOST_CELLS rows at most

        def place(batches: Iterator[pa.RecordBatch]):
            for b in batches:
                x = matrix(b.column(1))
                if len(sent.value):
                    cell, fit = nearest_cells(unit(x), sent.value)
                    cell[np.linalg.norm(x, axis=1) == 0] = NOWHERE
                else:
                    cell, fit = np.full(len(x), NOWHERE), np.ones(len(x))
                yield pa.record_batch([pa.array(cell.astype(np.int32)), pa.array(np.arccos(np.clip(fit, -1, 1))), *b.columns], names=["cell", "angle", "id", "vector", "scope"])

        kind = {f.name: f.dataType.simpleString() for f in rows.schema}
        placed = checkpointed(rows.mapInArrow(place, f"cell int, angle double, id {kind['id']}, vector array<double>, scope {kind['scope']}"))
        held = placed.groupBy("cell").agg(F.max("angle").alias("radius"), F.count("*").alias("n"), F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
        centres = rows.sparkSession.createDataFrame(pd.DataFrame({"cell": np.arange(len(c)), "centroid": [x.tolist() for x in c]}), "cell int, centroid array<double>")
        table = checkpointed(held.join(centres, "cell", "left").select("cell", "centroid", "radius", "n", "parts"))
        return cls(table, packed(placed.drop("angle"), table, BLOCK, "id", "vector"))

    @classmethod
    def write(cls, vectors: DataFrame, path: str, **how) -> VectorIndex:
        """An index in a folder; blocks lie by cell, so a search reads the row groups of its cells."""
        made = cls.build(vectors, **how)
        made.blocks.repartitionByRange("cell", "part").sortWithinPartitions("cell", "part").write.mode("overwrite").option("parquet.block.size", 16 << 20).parquet(f"{path}/blocks")
        made.cells.write.mode("overwrite").parquet(f"{path}/cells")
        return cls.open(vectors.sparkSession, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> VectorIndex:
        return cls(spark.read.parquet(f"{path}/cells"), spark.read.parquet(f"{path}/blocks"))

    def _meet(self, asked: DataFrame, k: int) -> DataFrame:
        """(query_id, id, similarity) from rows (query_id, query, scope, cell): queries of a cell go in packs to each of its blocks."""
        asked = checkpointed(asked)
        packs = packed(asked, asked.groupBy("cell").agg(F.count("*").alias("n")), QUERIES, "query_id", "query")
        parts = F.broadcast(self.cells.select("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).groupBy("cell").agg(F.collect_list("part").alias("parts")))
        sent = packs.select("cell", "scope", F.col("members").alias("asked")).join(parts, "cell").withColumn("part", F.explode("parts")).drop("parts")
        needed = [r[0] for r in asked.select("cell").distinct().collect()]  # MOST_CELLS at most; they reach the scan
        blocks = self.blocks.where(F.col("cell").isin(needed))
        kinds = {"id": self.blocks.schema["members"].dataType.elementType["id"].dataType.simpleString(), "query_id": asked.schema["query_id"].dataType.simpleString()}
        return best_of_blocks(blocks.join(sent, ["cell", "scope", "part"]), k, kinds["id"], kinds["query_id"])

    def search(self, queries: DataFrame, k: int, probes: int = 8, exact: bool = False, scope: str | None = None) -> DataFrame:
        """(query_id, id, similarity, rank): the k nearest by cosine of each row of queries (query_id, query), ties by id.

        Reads ``probes`` cells a query (the one of vectors of length 0 is the first, if there are any) and, if ``exact``, each other cell that may hold one of the k nearest. ``scope`` is the
        queries' column that must equal the one that the index was built with.
        """
        ordered, real = self._ordered(queries, scope)
        found = self._meet(ordered.select("query_id", "query", "scope", F.explode(F.slice("cells", 1, probes)).alias("cell")), k)
        if exact and real > probes:
            found = checkpointed(_ranked(found, k).drop("rank"))
            edge = found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("similarity").alias("s"))
            edge = edge.select("query_id", F.when(F.col("n") >= k, F.col("s")).alias("s"))
            rest = ordered.join(edge, "query_id", "left").select("query_id", "query", "scope", "s", F.explode(F.slice(F.arrays_zip("cells", "bounds"), probes + 1, real)).alias("x"))
            rest = rest.where(F.col("s").isNull() | (F.col("x.bounds") >= F.col("s"))).select("query_id", "query", "scope", F.col("x.cells").alias("cell"))
            found = found.unionByName(self._meet(rest, k))
        return _ranked(found, k).drop("cell")

    def _ordered(self, queries: DataFrame, scope: str | None) -> tuple[DataFrame, int]:
        """(query_id, query, scope, cells, bounds): the cells in the order in which a query looks at them, with the best that they can hold; and how many there are."""
        at = F.col(scope) if scope else F.lit(0)
        rows = queries.where("query IS NOT NULL").select("query_id", F.col("query").cast("array<double>").alias("query"), at.alias("scope"))
        kind = {f.name: f.dataType.simpleString() for f in rows.schema}
        cells = self.cells.toPandas()  # MOST_CELLS rows at most
        real = cells[cells["centroid"].notna()]
        c = np.array(real["centroid"].tolist()).reshape(len(real), -1) if len(real) else np.zeros((0, 1))
        sent = queries.sparkSession.sparkContext.broadcast((real["cell"].to_numpy(), c, real["radius"].to_numpy(), bool((cells["cell"] == NOWHERE).any())))

        def order(batches: Iterator[pa.RecordBatch]):
            own, centres, radius, nowhere = sent.value
            for b in batches:
                s = unit(matrix(b.column(1))) @ centres.T if len(own) else np.zeros((b.num_rows, 0))
                bound = np.cos(np.maximum(0, np.arccos(np.clip(s, -1, 1)) - radius)) + 1e-9
                near = np.argsort(-s, axis=1, kind="stable")
                ids = [[NOWHERE] * nowhere + own[x].tolist() for x in near]
                most = [[2.0] * nowhere + y[x].tolist() for x, y in zip(near, bound, strict=True)]
                yield pa.record_batch([*b.columns, pa.array(ids, pa.list_(pa.int32())), pa.array(most, pa.list_(pa.float64()))], names=["query_id", "query", "scope", "cells", "bounds"])

        schema = f"query_id {kind['query_id']}, query array<double>, scope {kind['scope']}, cells array<int>, bounds array<double>"
        return rows.mapInArrow(order, schema), len(cells)

    def probes_for(self, k: int, least: float = 0.95, sample: int = 200) -> int:
        """How many cells a search for k neighbours must read so that it finds a share ``least`` of them, by an exact
        search for at most ``sample`` of the index's own vectors, chosen by hash."""
        own = self.blocks.select("scope", F.explode("members").alias("x")).select(F.col("x.id").alias("query_id"), F.col("x.vector").alias("query"), "scope")
        some = checkpointed(own.orderBy(F.xxhash64("query_id"), "query_id").limit(sample))
        ordered, n = self._ordered(some, "scope")
        ordered = checkpointed(ordered)
        found = _ranked(self._meet(ordered.select("query_id", "query", "scope", F.explode("cells").alias("cell")), k), k)
        at = found.join(ordered.select("query_id", "cells"), "query_id").select(F.array_position("cells", F.col("cell")).alias("at"))
        places = at.groupBy("at").count().orderBy("at").toPandas()  # one row a cell
        share = places["count"].cumsum() / max(1, places["count"].sum())
        return int(places["at"][share >= least].min()) if len(places) else n


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(n_queries, n_pairs, recall): the share of the exact neighbours (query_id, id) that were found."""
    hit = exact.select("query_id", "id").join(found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    return hit.agg(F.countDistinct("query_id").alias("n_queries"), F.count("*").alias("n_pairs"), (F.sum(F.coalesce("hit", F.lit(0))) / F.count("*")).alias("recall"))
