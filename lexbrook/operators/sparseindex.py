"""Sparse vectors by impact: a token's weights lie in blocks, highest first, and a query stops where the rest cannot matter.

A block holds at most ``BLOCK`` weights of one token and knows its highest. A search for the k best reads the first block of
each of a query's tokens, then the next three, the next twelve, and so on. Sums of what was read are lower bounds, so the k-th
best of them, s, is one for the k-th best score; a vector that is in no block read so far can have at most r, the sum of
the query's weights times the highest weights of the tokens' next blocks. Once r < s, only vectors seen can be
among the best, and of these only those with sum + r >= s. Their scores are then worked out from the vectors themselves. Results are
those of the full join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lineage import checkpointed, numbered

BLOCK, GROWTH, SLACK = 128, 4, 1e-9
#: Weights that a round reads for all queries together: so many, or so small a part of all that their tokens have; else queries are compared with all vectors.
LITTLE, PART = 2_000_000, 1 / 256
#: Vectors of a block, queries of a pack and tokens of a product.
MEMBERS, PACK, COLUMNS = 4096, 256, 512


def best_of_blocks(met: DataFrame, k: int, id_kind: str, query_kind: str) -> DataFrame:
    """(query_id, id, sum): from rows (members, asked) the k best of each query within each block with a sum above 0, and all that tie with the last, nearly."""

    def entries(rows: pa.StructArray):
        """(row, token, weight) of each entry of rows (tokens, weights)."""
        sizes = rows.field("tokens").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        return np.repeat(np.arange(len(rows)), sizes), rows.field("tokens").flatten().to_numpy(), rows.field("weights").flatten().to_numpy()

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for i in range(b.num_rows):
                members, asked = b.column("members")[i].values, b.column("asked")[i].values
                (v, vt, vw), (q, qt, qw) = entries(members), entries(asked)
                known = np.unique(qt)
                vat, qat = np.searchsorted(known, vt), np.searchsorted(known, qt)
                there = vat < len(known)
                there[there] = known[vat[there]] == vt[there]
                v, vat, vw = v[there], vat[there], vw[there]
                s = np.zeros((len(asked), len(members)))
                for low in range(0, len(known), COLUMNS):
                    x, y = np.zeros((len(asked), COLUMNS)), np.zeros((len(members), COLUMNS))
                    own, of = qat // COLUMNS == low // COLUMNS, vat // COLUMNS == low // COLUMNS
                    x[q[own], qat[own] - low], y[v[of], vat[of] - low] = qw[own], vw[of]
                    s += x @ y.T
                keep = s > 0
                if s.shape[1] > k:
                    keep &= s + SLACK >= np.partition(s, s.shape[1] - k, axis=1)[:, -k, None]
                one, other = np.nonzero(keep)
                yield pa.record_batch([asked.field("query_id").take(pa.array(one)), members.field("id").take(pa.array(other)), pa.array(s[one, other])], names=["query_id", "id", "sum"])

    return met.select("members", "asked").mapInArrow(run, f"query_id {query_kind}, id {id_kind}, sum double")


class SparseIndex:
    """blocks (token_id, place, most, n, members), place 0 being a token's first, and vectors (id, tokens)."""

    def __init__(self, blocks: DataFrame, vectors: DataFrame):
        self.blocks, self.vectors = blocks, vectors

    @classmethod
    def build(cls, terms: DataFrame, block: int = BLOCK) -> SparseIndex:
        """An index of all rows (id, token_id, weight) with a weight above 0; weights of the same id and token add up.

        A token that most vectors have is sorted in many tasks, as are all rows together; blocks are cut by global places, so none reaches across tokens.
        """
        kept = terms.where("weight > 0 AND id IS NOT NULL AND token_id IS NOT NULL").groupBy("id", "token_id").agg(F.sum("weight").alias("weight"))
        placed = numbered(kept, "at", F.col("token_id"), F.col("weight").desc(), F.col("id"))
        cut = F.floor(F.col("at") / block)
        blocks = placed.groupBy("token_id", cut.alias("cut")).agg(F.max("weight").alias("most"), F.count("*").alias("n"), F.collect_list(F.struct("id", "weight")).alias("members"))
        first = placed.groupBy("token_id").agg(F.min(cut).alias("first"))
        blocks = blocks.join(first, "token_id").select("token_id", (F.col("cut") - F.col("first")).cast("int").alias("place"), "most", "n", "members")
        vectors = kept.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("token_id", "weight"))).alias("tokens"))
        return cls(checkpointed(blocks), checkpointed(vectors))

    @classmethod
    def write(cls, terms: DataFrame, path: str, block: int = BLOCK) -> SparseIndex:
        """An index in a folder; blocks lie by token and place, so a round reads the row groups of its tokens."""
        made = cls.build(terms, block)
        made.blocks.repartitionByRange("token_id", "place").sortWithinPartitions("token_id", "place").write.mode("overwrite").parquet(f"{path}/blocks")
        made.vectors.repartitionByRange("id").sortWithinPartitions("id").write.mode("overwrite").parquet(f"{path}/vectors")
        return cls.open(terms.sparkSession, path)

    @classmethod
    def open(cls, spark, path: str) -> SparseIndex:
        return cls(spark.read.parquet(f"{path}/blocks"), spark.read.parquet(f"{path}/vectors"))

    def search(self, queries: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
        """The k best of each query and what it took: (query_id, id, score, rank) and (query_id, n_read, n_total), weights read and
        weights that its tokens have. queries: (query_id, token_id, w); only weights above 0 count."""
        asked = checkpointed(queries.where("w > 0 AND token_id IS NOT NULL").groupBy("query_id", "token_id").agg(F.sum("w").alias("w")))
        known = self.blocks.select("token_id", "place", "most", "n")
        total = asked.join(known.groupBy("token_id").agg(F.sum("n").alias("n")), "token_id").groupBy("query_id").agg(F.sum("n").alias("n_total"))
        active, low, high = asked, 0, 1
        seen, read, candidates = None, None, []
        kinds = {"query_id": queries.schema["query_id"].dataType.simpleString(), "id": self.vectors.schema["id"].dataType.simpleString()}
        while not active.isEmpty():
            ahead = active.join(known, "token_id").agg(F.sum(F.when(F.col("place").between(low, high - 1), F.col("n"))).alias("now"), F.sum("n").alias("all")).first()
            if (ahead["now"] or 0) > max(LITTLE, PART * ahead["all"]):
                candidates.append(self._among_all(active, k, kinds))
                left = total.join(active.select("query_id").distinct(), "query_id", "left_semi").select("query_id", F.col("n_total").alias("n_read"))
                read = left if read is None else left.unionByName(read.join(left, "query_id", "left_anti"))
                break
            blocks = self.blocks.where(F.col("place").between(low, high - 1))
            met = active.join(blocks, "token_id").select("query_id", "w", "n", F.explode("members").alias("x")).select("query_id", F.col("x.id").alias("id"), (F.col("w") * F.col("x.weight")).alias("part"))
            met = met.groupBy("query_id", "id").agg(F.sum("part").alias("sum"))
            more = active.join(known.where(F.col("place").between(low, high - 1)), "token_id").groupBy("query_id").agg(F.sum("n").alias("n_read"))
            read = more if read is None else read.unionByName(more)
            if seen is not None:
                met = met.unionByName(seen.join(active.select("query_id").distinct(), "query_id", "left_semi")).groupBy("query_id", "id").agg(F.sum("sum").alias("sum"))
            seen = checkpointed(met)
            order = Window.partitionBy("query_id").orderBy(F.desc("sum"), "id")
            least = seen.withColumn("o", F.row_number().over(order)).where(F.col("o") <= k).where(F.col("o") == k).select("query_id", F.col("sum").alias("s"))
            rest = active.join(known.where(F.col("place") == high), "token_id").groupBy("query_id").agg(F.sum(F.col("w") * F.col("most")).alias("r"))
            state = active.select("query_id").distinct().join(least, "query_id", "left").join(rest, "query_id", "left").withColumn("r", F.coalesce("r", F.lit(0.0)))
            state = checkpointed(state.withColumn("ready", (F.col("r") == 0) | (F.col("r") + SLACK < F.col("s"))))
            ready = state.where(F.coalesce("ready", F.lit(False)))
            candidates.append(seen.join(ready, "query_id").where(F.col("s").isNull() | (F.col("sum") + F.col("r") + SLACK >= F.col("s"))).select("query_id", "id"))
            active = checkpointed(active.join(ready.select("query_id"), "query_id", "left_anti"))
            low, high = high, high * GROWTH
        spark = queries.sparkSession
        found = spark.createDataFrame([], f"query_id {kinds['query_id']}, id {kinds['id']}")
        for c in candidates:
            found = found.unionByName(c)
        wanted = asked.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("token_id", "w"))).alias("wanted"))
        whole = found.join(self.vectors, "id").join(wanted, "query_id")
        score = F.aggregate("wanted", F.lit(0.0), lambda s, x: s + x["w"] * F.coalesce(F.element_at("tokens", x["token_id"]), F.lit(0.0)))
        scored = whole.select("query_id", "id", score.alias("score"))
        best = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)
        used = total if read is None else total.join(read.groupBy("query_id").agg(F.sum("n_read").alias("n_read")), "query_id")
        return best, used

    def _among_all(self, active: DataFrame, k: int, kinds: dict[str, str]) -> DataFrame:
        """(query_id, id) of the k best of each query (query_id, token_id, w) and of what nearly ties with the last, by comparing it with all vectors."""
        spread = lambda rows, key, size: rows.withColumn("part", F.pmod(F.xxhash64(key), F.lit(max(1, -(-rows.count() // size)))))
        own = self.vectors.select("id", F.map_keys("tokens").alias("tokens"), F.map_values("tokens").alias("weights"))
        members = spread(own, "id", MEMBERS).groupBy("part").agg(F.collect_list(F.struct("id", "tokens", "weights")).alias("members"))
        listed = active.groupBy("query_id").agg(F.collect_list(F.struct("token_id", "w")).alias("x")).select("query_id", F.col("x.token_id").alias("tokens"), F.col("x.w").alias("weights"))
        packs = spread(listed, "query_id", PACK).groupBy("part").agg(F.collect_list(F.struct("query_id", "tokens", "weights")).alias("asked"))
        met = members.select("members").crossJoin(packs.select("asked")).repartition(self.blocks.sparkSession.sparkContext.defaultParallelism * 4)
        best = best_of_blocks(met, k, kinds["id"], kinds["query_id"])
        order = Window.partitionBy("query_id").orderBy(F.desc("sum"), "id")
        last = F.max(F.when(F.col("o") == k, F.col("sum"))).over(Window.partitionBy("query_id"))
        near = best.withColumn("o", F.row_number().over(order)).withColumn("s", last)
        return near.where(F.col("s").isNull() | (F.col("sum") + SLACK >= F.col("s"))).select("query_id", "id")
