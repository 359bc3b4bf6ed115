"""A full-text index: postings written once, by term, and read by the terms that a query asks for.

A posting is (term, field, doc, tf, positions, own, length): own is the number of words of the field in the
document, length that of all indexed fields. On disk postings lie in folders by a hash of the term and, within, in files by a
hash of the document, so that a frequent term is spread over ``shards`` tasks; files are sorted by term, so a query
reads the row groups of its terms only. Beside them lie the number of documents of each term, in folders by the same
hash, and, if asked for, the documents' own columns in folders by a hash of the id, sorted by id: the few rows of a
result are fetched from the row groups that hold them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import col, tokens
from .lineage import shared_folder

BUCKETS = 32
#: Characters of text that one shard of a bucket holds, about: so many that its task sorts them in memory.
SHARD_CHARS = 1 << 28
#: Words that a Python worker looks at together, about.
WORDS = 1 << 20


def postings(df: DataFrame, fields: list[str], id_col: str = "decision_id") -> DataFrame:
    """(doc, field, term, tf, positions, own, length) of all fields. Null ids have none; rows that repeat an id are one document."""
    return _merged(_opened(_packed(df, fields, id_col), fields))


def _merged(rows: DataFrame, *keys: str) -> DataFrame:
    """The postings of rows that repeat an id as one."""
    per = rows.groupBy(*keys, "doc", "field", "term")
    return per.agg(F.sum("tf").alias("tf"), F.array_sort(F.flatten(F.collect_list("positions"))).alias("positions"), F.first("own").alias("own"), F.first("length").alias("length"))


def _packed(df: DataFrame, fields: list[str], id_col: str) -> DataFrame:
    """A row for each document and bucket with all of its postings there, side by side; what is shuffled are these, not words."""
    words = df.select(col(id_col).alias("doc"), *(tokens(f).alias(f"w{i}") for i, f in enumerate(fields))).where("doc IS NOT NULL")
    length = sum((F.size(f"w{i}") for i in range(len(fields))), F.lit(0))
    kind = words.schema["doc"].dataType.simpleString()

    def run(batches):
        for b in batches:
            held = np.cumsum(sum(pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns[2:]))
            cuts = np.flatnonzero(np.diff(held // WORDS)) + 1 if b.num_rows else []
            for start, end in zip([0, *cuts], [*cuts, b.num_rows]):
                yield _pack(b.slice(start, end - start))

    return words.select("doc", length.alias("length"), *(f"w{i}" for i in range(len(fields)))).mapInArrow(
        run, f"doc {kind}, length int, bucket int, terms string, fields array<tinyint>, own array<int>, tf array<int>, first array<boolean>, ends array<int>, positions array<int>"
    )


def _pack(b: pa.RecordBatch) -> pa.RecordBatch:
    """Rows (doc, length, words of each field) as (doc, length, bucket, postings): the words of a row by bucket, term and field, counted."""
    columns, n_fields = b.columns[2:], b.num_columns - 2
    sizes = [pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns]
    coded = pa.concat_arrays([c.flatten() for c in columns]).dictionary_encode()
    code, terms = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    bucket = np.array([xxhash.xxh64_intdigest(t, 42) for t in terms.to_pylist()], np.uint64).view(np.int64) % BUCKETS  # as bucket_of
    row = np.concatenate([np.repeat(np.arange(b.num_rows), n) for n in sizes])
    field = np.repeat(np.arange(n_fields), [n.sum() for n in sizes])
    place = np.concatenate([np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) for n in sizes])
    key = ((row * BUCKETS + bucket[code]) * max(1, len(terms)) + code) * n_fields + field
    order = np.argsort(key, kind="stable")  # so places stay in order
    key = key[order]
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)  # where a posting begins
    of = order[at]
    tf = np.diff(np.r_[at, len(key)])
    word = key[at] // n_fields
    first = np.r_[True, word[1:] != word[:-1]] if len(at) else np.zeros(0, bool)
    home = row[of] * BUCKETS + bucket[code[of]]
    begin = np.flatnonzero(np.r_[True, home[1:] != home[:-1]]) if len(at) else np.zeros(0, np.int64)  # where a row begins
    lists = pa.array(np.r_[begin, len(at)], pa.int32())
    bases = np.r_[at, len(key)][np.r_[begin, len(at)]]
    ends = at + tf - np.repeat(bases[:-1], np.diff(np.r_[begin, len(at)]))
    whose = row[of[begin]]
    own = np.stack(sizes)[field[of], row[of]]
    listed = lambda x, kind: pa.ListArray.from_arrays(lists, pa.array(x, kind))
    named = pa.ListArray.from_arrays(lists, terms.take(pa.array(code[of])).cast(pa.string()))
    return pa.record_batch(
        [
            b.column(0).take(pa.array(whose)), b.column(1).take(pa.array(whose)), pa.array(home[begin] % BUCKETS, pa.int32()), pc.binary_join(named, " "), listed(field[of], pa.int8()),
            listed(own, pa.int32()), listed(tf, pa.int32()), listed(first, pa.bool_()), listed(ends, pa.int32()), pa.ListArray.from_arrays(pa.array(bases, pa.int32()), pa.array(place[order], pa.int32())),
        ],
        names=["doc", "length", "bucket", "terms", "fields", "own", "tf", "first", "ends", "positions"],
    )


def _opened(packed: DataFrame, fields: list[str], *keys: str) -> DataFrame:
    """A row for each posting; first: whether no field before has the term in that document."""
    one = lambda c: F.get(c, F.col("k"))
    rows = packed.select(*keys, "doc", "length", "fields", "own", "tf", "first", "ends", "positions", F.posexplode(F.split("terms", " ")).alias("k", "term"))
    places = F.slice("positions", one("ends") - one("tf") + 1, one("tf"))
    name = F.get(F.array(*map(F.lit, fields)), one("fields").cast("int"))
    return rows.select(*keys, "doc", name.alias("field"), "term", one("tf").cast("long").alias("tf"), places.alias("positions"), one("own").alias("own"), "length", one("first").alias("first"))


def folder_of(doc, folders: int) -> Column:
    return F.pmod(F.xxhash64(doc), F.lit(folders)).cast("int")


def bucket_of(term) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


#: Documents that a folder of the store holds, about, and bytes of a row group.
FOLDER_DOCS, GROUP_BYTES = 20_000, 1 << 20


@dataclass
class Index:
    """Postings, and what scores need to know of all documents: their number and their words, by field and in all; documents
    by term; and the store of documents, if there is one."""

    rows: DataFrame
    docs: int
    words: dict[str, int]
    terms: DataFrame | None = None
    store: DataFrame | None = None
    folders: int = 1
    id_col: str = "decision_id"

    @classmethod
    def of(cls, df: DataFrame, fields: list[str], id_col: str = "decision_id") -> Index:
        """An index that is made anew for each query; for small tables."""
        counted = df.where(col(id_col).isNotNull()).agg(F.countDistinct(col(id_col)).alias("n"), *(F.sum(F.size(tokens(f))).alias(f"w_{f}") for f in fields)).first()
        return cls(postings(df, fields, id_col).withColumn("bucket", bucket_of("term")), counted["n"], {f: counted[f"w_{f}"] or 0 for f in fields})

    @classmethod
    def write(cls, df: DataFrame, path: str, fields: list[str], id_col: str = "decision_id", keep: list[str] | None = None) -> Index:
        """Make an index on disk: words are counted where the documents lie, and dealt out once, by term and document. ``keep``: columns of
        the documents to be fetched by id."""
        spark = df.sparkSession
        there = F.when(F.col(id_col).isNotNull(), F.col(id_col))
        sized = df.agg(sum((F.coalesce(F.sum(F.length(col(f).cast("string"))), F.lit(0)) for f in fields), F.lit(0)).alias("chars"), F.count("*").alias("n"), F.count(there).alias("ids"), F.countDistinct(there).alias("docs")).first()
        shards = max(1, -(-sized["chars"] // SHARD_CHARS))
        shard = F.pmod(F.xxhash64("doc"), F.lit(shards)).cast("int")
        dealt = _opened(_packed(df, fields, id_col).withColumn("shard", shard).repartition(BUCKETS * shards, "bucket", "shard"), fields, "bucket", "shard")
        again = sized["ids"] > sized["docs"]
        whole = _merged(dealt, "bucket", "shard").withColumn("first", F.lit(None).cast("boolean")) if again else dealt
        whole.drop("shard").sortWithinPartitions("bucket", "term").write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{path}/postings")
        written = spark.read.parquet(f"{path}/postings")
        df_of = F.countDistinct("doc") if again else F.count(F.when(F.col("first"), 1))
        written.groupBy("bucket", "term").agg(df_of.alias("df")).repartition("bucket").sortWithinPartitions("term").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/terms")
        used = {r["field"]: r["n"] for r in written.groupBy("field").agg(F.sum("tf").alias("n")).collect()}  # a row a field
        folders = max(1, sized["n"] // FOLDER_DOCS)
        if keep is not None:
            own = df.where(F.col(id_col).isNotNull()).select(*dict.fromkeys([id_col, *keep])).withColumn("folder", folder_of(id_col, folders))
            own.repartition(folders, "folder").sortWithinPartitions("folder", id_col).write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", GROUP_BYTES).partitionBy("folder").parquet(f"{path}/store")
        docs = spark.range(1).select(F.lit(sized["docs"]).alias("docs"), F.lit(folders).alias("folders"), F.lit(keep is not None).alias("kept"), F.lit(id_col).alias("id_col"))
        docs.select("*", *(F.lit(used.get(f, 0)).cast("long").alias(f"w_{f}") for f in fields)).coalesce(1).write.mode("overwrite").parquet(f"{path}/totals")
        return cls.open(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Index:
        total = spark.read.parquet(f"{path}/totals").first().asDict()
        store = spark.read.parquet(f"{path}/store") if total["kept"] else None
        words = {f[2:]: n for f, n in total.items() if f.startswith("w_")}
        return cls(spark.read.parquet(f"{path}/postings").drop("first"), total["docs"], words, spark.read.parquet(f"{path}/terms"), store, total["folders"], total["id_col"])

    def frequencies(self, terms: list[str], fields: list[str] | None = None) -> dict[str, int]:
        """In how many documents each term is; terms that are in none are left out. A row a term is collected."""
        terms = sorted(set(terms))
        if not terms:
            return {}
        if self.terms is None or (fields is not None and not set(fields) >= set(self.words)):
            found = self.asked(terms, fields=fields).groupBy("term").agg(F.countDistinct("doc").alias("df"))
        else:
            found = self.terms.where(F.col("bucket").isin(self._buckets(terms)) & F.col("term").isin(terms))
        return {r["term"]: r["df"] for r in found.select("term", "df").collect()}

    def fetch(self, ids: list) -> DataFrame:
        """The stored rows of some ids. Folders are told from the ids, and the ids reach the files as equalities, so only row groups
        are read that may hold one."""
        spark, ids = self.store.sparkSession, sorted(set(ids))
        most = "spark.sql.parquet.pushdown.inFilterThreshold"
        spark.conf.set(most, str(max(int(spark.conf.get(most)), len(ids))))
        if not ids:
            return self.store.drop("folder").limit(0)
        folders = [r[0] for r in spark.createDataFrame([(x,) for x in ids], f"id {self.store.schema[self.id_col].dataType.simpleString()}").select(folder_of("id", self.folders)).distinct().collect()]
        return self.store.where(F.col("folder").isin(folders) & F.col(self.id_col).isin(ids)).drop("folder")

    def _buckets(self, terms: list[str]) -> list[int]:
        spark = self.rows.sparkSession
        return [r[0] for r in spark.range(1).select(F.explode(F.array(*(bucket_of(F.lit(t)) for t in terms))).alias("b")).distinct().collect()]

    def asked(self, terms: list[str], prefixes: list[str] = (), fields: list[str] | None = None) -> DataFrame:
        """The postings of some terms and of all that begin with a prefix; only those buckets are read that can hold them."""
        terms, prefixes = sorted(set(terms)), sorted(set(prefixes))
        wanted = F.col("bucket").isin(self._buckets(terms)) & F.col("term").isin(terms) if terms else F.lit(False)
        for p in prefixes:
            wanted |= F.col("term").startswith(p)
        out = self.rows.where(wanted)
        return out if fields is None or set(fields) >= set(self.words) else out.where(F.col("field").isin(list(fields)))

    def mean_length(self, fields: list[str] | None = None) -> float:
        used = self.words if fields is None else [f for f in fields if f in self.words]
        return sum(self.words[f] for f in used) / self.docs if self.docs else 1.0


_OPENED: dict[tuple, Index] = {}


def index_for(spark: SparkSession, name: str, make, fields: list[str], id_col: str = "decision_id", keep: list[str] | None = None) -> Index:
    """The index of that name in the shared folder; made from make() when it is asked for first in this application."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _OPENED:
        _OPENED[key] = Index.write(make(), f"{shared_folder(spark)}/index-{abs(hash(key)):x}", fields, id_col, keep)
    return _OPENED[key]
