"""Importance resampling towards a target distribution, by a dictionary of distinct features.

A text's features are its runs of 1 to ``n`` words; a feature falls in one of ``buckets`` by the crc32 of its bytes.
A bucket's gain is floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))), where s of all S features of the documents and t of
all T features of the target are in it. A document's weight is the sum of its features' gains, its score the weight plus
Gumbel noise that a keyed hash of its id gives, so that the highest scores are a sample without replacement.

No string is hashed twice:

1. Documents are cut into features by Arrow kernels, block by block (``BLOCK_BYTES`` of text, or one longer text). A block
   lists each distinct feature once; its documents refer to them by their places in the list. Blocks are written
   to the shared folder, so texts are read and cut once, and a lost executor costs no more than its own blocks.
2. Lists of documents and target are counted together: one dictionary row a distinct string, hashed there. Even the
   commonest word has one row a block.
3. Counts are summed by bucket; gains are as many rows as there are buckets (a parameter), so they are broadcast.
4. Gains go back to the blocks' places by a join on the string, and to the documents by places.

Results for odd rows: null is a text without words. A text without features weighs 0. Rows with a null id get noise for the
empty id (``2024:``) and come last among equal scores. Every row counts and is scored as often as it occurs; equal rows have
neighbouring ranks. An empty table gives no rows; without a target text, T is 0. Other columns are not looked at and
can be carried along, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexbrook.operators.lineage import numbered

from .common import checkpointed, pieces, release_memory, rows_of

#: Bytes of text in a block.
BLOCK_BYTES = 8 << 20
#: What each byte becomes within a word (A-Z in lower case), or 0 where words end.
IN_WORD = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts in a row, and for each word the number of its text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return pa.array([], pa.large_string()), np.zeros(0, np.int64)
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    own = IN_WORD[np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]] if data else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    inside = own > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = ends[:-1][ends[:-1] < len(own)]
    begins[first] = inside[first]  # words end with their text
    at = np.flatnonzero(begins)
    places = np.r_[np.cumsum(inside)[at] - 1, inside.sum()].astype(np.int64)
    words = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(places), pa.py_buffer(own[inside])])
    return words, np.searchsorted(ends, at, side="right") - 1


def features_of(texts: pa.Array, n: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct features of some texts; for each feature of each text its place there and its text's number; words a text."""
    words, row = words_of(texts)
    runs, rows = [words], [row]
    for k in range(2, n + 1):
        at = np.flatnonzero(row[: len(row) - k + 1] == row[k - 1 :]) if len(row) >= k else np.zeros(0, np.int64)
        runs.append(pc.binary_join_element_wise(*(words.take(pa.array(at + i)) for i in range(k)), pa.scalar(" ", pa.large_string())))
        rows.append(row[at])
    coded = pa.chunked_array(runs).combine_chunks().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate(rows), np.bincount(row, minlength=len(texts))


def packed(numbers: np.ndarray) -> bytes:
    return zstandard.compress(numbers.astype(np.int32).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), np.int32)


def block_of(rows: pa.Table, n: int) -> dict[str, pa.Array]:
    """One row with the distinct features of rows (id, text and maybe carry), and which of them each row has, how often."""
    known, code, row, n_words = features_of(rows.column(1).combine_chunks(), n)
    width = max(1, len(known))
    pairs, counts = np.unique(row * width + code, return_counts=True)
    of, places = pairs // width, pairs % width

    def one(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    found = {
        "features": one(known.cast(pa.string())), "totals": one(pa.array(np.bincount(code, minlength=len(known)))), "ids": one(rows.column(0).combine_chunks()),
        "n_words": one(pa.array(n_words)), "kinds": one(pa.array(np.bincount(of, minlength=rows.num_rows))),
        "places": pa.array([packed(np.diff(places, prepend=0))], pa.binary()), "counts": pa.array([packed(counts)], pa.binary()),
    }
    if rows.num_columns > 2:
        found["carry"] = one(rows.column(2).combine_chunks())
    return found


def blocks(rows: DataFrame, n: int, block_bytes: int) -> DataFrame:
    """Rows (id, text and maybe carry) as blocks, each a row with a number of its own."""
    kind = {c: rows.schema[c].dataType.simpleString() for c in rows.columns}
    schema = f"block long, features array<string>, totals array<long>, ids array<{kind['id']}>, n_words array<long>, kinds array<long>, places binary, counts binary"
    schema += f", carry array<{kind['carry']}>" if "carry" in kind else ""

    def run(batches):
        number = TaskContext.get().partitionId() << 32

        def full(held):
            nonlocal number
            made = block_of(pa.Table.from_batches(held), n)
            number += 1
            return pa.record_batch([pa.array([number - 1]), *made.values()], names=["block", *made])

        held, size = [], 0
        for b in pieces(batches, "text", block_bytes):
            more = pc.sum(pc.binary_length(b.column(1))).as_py() or 0
            if held and size + more > block_bytes:
                yield full(held)
                held, size = [], 0
            held.append(b)
            size += more
        if held:
            yield full(held)
        del held
        release_memory()

    return rows.mapInArrow(run, schema)


def weighed(coded: DataFrame, gains: DataFrame, carry: list[str] | None) -> DataFrame:
    """(id, n_words, n_features, weight and maybe carry) for each row of the blocks; gains: (block, gains by place)."""
    laid = coded.join(gains, "block", "left")
    kind = coded.schema["ids"].dataType.elementType.simpleString()
    schema = f"id {kind}, n_words long, n_features long, weight long" + (f", carry {coded.schema['carry'].dataType.elementType.simpleString()}" if carry else "")
    names = ["id", "n_words", "n_features", "weight", "carry"][: 5 if carry else 4]

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                r = {c: b.column(c)[i] for c in b.schema.names}
                gain = r["gains"].values.to_numpy(zero_copy_only=False) if r["gains"].is_valid else np.zeros(0, np.int64)
                kinds, counts = r["kinds"].values.to_numpy(), unpacked(r["counts"].as_py()).astype(np.int64)
                places = np.cumsum(unpacked(r["places"].as_py()), dtype=np.int64)
                ends = np.r_[0, np.cumsum(kinds)]
                n_features, weight = (np.r_[0, np.cumsum(x)] for x in (counts, gain[places] * counts))
                columns = [r["ids"].values, r["n_words"].values, *(pa.array(x[ends[1:]] - x[ends[:-1]], pa.int64()) for x in (n_features, weight))]
                yield pa.record_batch(columns + ([r["carry"].values] if carry else []), names=names)
        release_memory()

    return laid.select("ids", "n_words", "kinds", "places", "counts", "gains", *(["carry"] if carry else [])).mapInArrow(run, schema)


def importance(
    docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: str = "2024",
    id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank, carry) for each row of docs; ``target`` has a column of the same name with its texts.

    rank is 1, 2, 3 ... for the ``percent`` of the documents with at least ``least_words`` words that score highest, ties by
    the smaller id, and null for all others: ``where("rank IS NOT NULL")`` is the resampled corpus.
    """
    coded = checkpointed(blocks(rows_of(docs, id_col, text_col, carry), n, block_bytes))
    wanted = blocks(target.select(F.lit(0).alias("id"), F.col(text_col).alias("text")), n, block_bytes)

    def listed(made: DataFrame, name: str, other: str) -> DataFrame:
        each = made.select(F.explode(F.arrays_zip("features", "totals")).alias("x"))
        return each.select(F.col("x.features").alias("feature"), F.col("x.totals").alias(name), F.lit(0).cast("long").alias(other)).select("feature", "s", "t")

    counted = listed(coded, "s", "t").union(listed(wanted, "t", "s")).groupBy("feature").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    dictionary = checkpointed(counted.withColumn("bucket", F.pmod(F.crc32(F.col("feature").cast("binary")), F.lit(buckets))))
    filled = checkpointed(dictionary.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")))
    all_s, all_t = (float(x or 0) for x in filled.agg(F.sum("s"), F.sum("t")).first())
    ratio = (F.col("t").cast("double") + 1) * F.lit(all_s + buckets) / ((F.col("s").cast("double") + 1) * F.lit(all_t + buckets))
    gain = filled.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain"))
    known = dictionary.where("s > 0").join(F.broadcast(gain), "bucket").select("feature", "gain")

    asked = coded.select("block", F.posexplode("features").alias("place", "feature"))
    gains = asked.join(known, "feature").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "gain"))).alias("x")).select("block", F.col("x.gain").alias("gains"))

    found = weighed(coded, gains, carry)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = checkpointed(found.withColumn("score", F.col("weight") + noise))
    able = scored.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    ranked = numbered(able, "rank", F.col("score").desc(), F.col("id").asc_nulls_last())
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    return ranked.union(rest).select(F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", rank.alias("rank"), *(["carry"] if carry else []))


def oracle(buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: str = "2024") -> str:
    """SQL for the rows of the query (runs of one word), with the crc32 of each distinct word worked out from its bytes."""
    words = r"unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))"
    step = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return f"""WITH RECURSIVE bits AS (SELECT n, n::BIGINT AS c, 0 AS k FROM range(256) t(n) UNION ALL SELECT n, {step}, k + 1 FROM bits WHERE k < 8),
    steps AS (SELECT list(c ORDER BY n) AS crc FROM bits WHERE k = 8),
    d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
    dw AS (SELECT rid, w, count(*) AS n FROM (SELECT rid, {words} AS w FROM d) GROUP BY rid, w),
    bw AS (SELECT w, count(*) AS n FROM (SELECT {words} AS w FROM benchmark) GROUP BY w),
    all_words AS (SELECT w, sum(s)::BIGINT AS s, sum(t)::BIGINT AS t FROM (SELECT w, n AS s, 0 AS t FROM dw UNION ALL SELECT w, 0, n FROM bw) GROUP BY w),
    dict AS (SELECT w, s, t, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, octet_length(encode(w)) + 1), lambda i: ('0x' || hex(encode(w))[2 * i - 1:2 * i])::BIGINT)),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) % {buckets} AS bucket FROM all_words, steps),
    filled AS (SELECT bucket, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM dict GROUP BY bucket),
    gains AS (SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + {buckets}) / ((s + 1) * (sum(t) OVER () + {buckets}))))::BIGINT AS gain FROM filled),
    w AS (SELECT rid, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM dw JOIN dict USING (w) JOIN gains USING (bucket) GROUP BY rid),
    scored AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
        + floor(-1000 * ln(-ln((('0x' || sha256('{seed}:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM d LEFT JOIN w USING (rid)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {least_words} ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_features >= {least_words}) OVER () AS able FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {least_words} AND place <= able * {percent} // 100 THEN place END AS rank FROM ranked"""
