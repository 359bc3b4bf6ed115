"""Benchmark decontamination by winnowing, in DataFrame operations only.

The k-grams of words of every text are hashed, and of each ``window`` consecutive hashes the least one
is kept. Two texts that share a span of window + k - 1 words or more keep the same k-gram of it, so
a join of the kept hashes finds every such span. Each find is extended: item and document are laid
on each other at the place of the find, and all windows of window + k - 1 item words that agree
there are hits. Items shorter than that are one window of their own: documents keep all their
grams of just those lengths for them.

Each pair of a document and an item text that a hash proposes is a row of its own until its words are compared, so a
passage that very many items share makes rows, never one row with all of them.

Defined results: null has no words; an item without words is never found; a document's words are
hit by any occurrence of a window, overlapping ones too. Repeated documents stay, with equal results. An item id is
listed once, however many items of that id are found; an item without an id hits words and is not listed. Without documents
there are no rows, without items no hits. Hashes only propose; words are compared. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, checkpointed, rows_of

#: What separates words once A-Z are lower-cased.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Bits of a packed k-gram for its place, as many as an array can have places; the rest are of its hash, which only proposes.
PLACE_BITS = 31

#: Items that a file of the checkpoint holds, about.
ITEMS_IN_FILE = 20_000


def words_of(text: Column) -> Column:
    """Lower-cased words; A-Z only."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NOT_WORD), lambda w: w != "")


def packed_grams(words: str, k: int) -> str:
    """SQL for each k-gram's hash in the upper bits and its place in the lower PLACE_BITS."""
    at = ", ".join(f"get({words}, i + {j})" for j in range(k))
    return f"CASE WHEN size({words}) >= {k} THEN transform(sequence(0, size({words}) - {k}), i -> (xxhash64({at}) & {-1 << PLACE_BITS}L) | i) ELSE array() END"


def winnowed(grams: str, window: int) -> str:
    """SQL for the packed k-grams that winnowing keeps: the least of each window, the first of equals."""
    least = ", ".join(f"get({grams}, i + {j})" for j in range(window))
    return f"CASE WHEN size({grams}) >= {window} THEN array_distinct(transform(sequence(0, size({grams}) - {window}), i -> least({least}))) ELSE array() END"


def _fingerprints(df: DataFrame, keep: list[str], k: int, window: int, lengths: list[int]) -> DataFrame:
    """(keep..., gram, hash, at): the winnowed k-grams as gram 0, and all grams of the lengths asked for."""
    kinds = [F.struct(F.lit(0).alias("gram"), F.expr(winnowed("grams", window)).alias("kept"))]
    kinds += [F.struct(F.lit(m).alias("gram"), F.expr(packed_grams("words", m)).alias("kept")) for m in lengths]
    rows = df.withColumn("grams", F.expr(packed_grams("words", k)))
    if lengths:
        rows = rows.select(*keep, F.explode(F.array(*kinds)).alias("x")).select(*keep, "x.gram", F.explode("x.kept").alias("p"))
    else:
        rows = rows.select(*keep, F.lit(0).alias("gram"), F.explode(F.expr(winnowed("grams", window))).alias("p"))
    return rows.select(*keep, "gram", F.shiftright("p", PLACE_BITS).alias("hash"), F.col("p").bitwiseAND((1 << PLACE_BITS) - 1).cast("int").alias("at"))


def decontaminate(docs: DataFrame, items: DataFrame, k: int = 5, window: int = 6, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(id, n_words, n_hit, items array, contaminated; with carry also the text and carry) for each row of docs; items: ids of those with a hit, sorted as text.

    Windows of window + k - 1 words count. The items' fingerprints are broadcast where Spark finds them
    small enough, else both sides are dealt out by hash.
    """
    span = window + k - 1
    # a row's content is its key: rows that share it have the same result
    rows = rows_of(docs, id_col, text_col, carry).withColumn("row", F.xxhash64("id", "text")).withColumn("row2", F.hash("text"))
    more = [F.col("text").alias("own"), "carry"] if carry else []
    asked = items.select(F.col(item_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("item_words")).where(F.size("item_words") > 0)
    asked = checkpointed(asked.withColumn("key", F.xxhash64("item_words")).coalesce(items.count() // ITEMS_IN_FILE + 1))  # not a file for each of a few items
    texts = asked.select("key", "item_words").distinct()  # equal items are looked for once
    n = F.size("item_words")
    lengths = sorted(r["n"] for r in texts.where(n < span).select(n.alias("n")).distinct().collect())  # fewer numbers than span
    prints = _fingerprints(texts.withColumn("words", F.col("item_words")), ["key", "item_words"], k, window, lengths).where(((F.col("gram") == 0) & (n >= span)) | (F.col("gram") == n))
    prints = prints.select("key", "gram", "hash", F.col("at").alias("item_at"))
    own = _fingerprints(rows.select("row", "row2", words_of(F.col("text")).alias("words")), ["row", "row2"], k, window, lengths)
    met = own.join(prints, ["gram", "hash"]).select("row", "row2", "key", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    proposed = checkpointed(met.groupBy("row", "row2", "key").agg(F.collect_list("shift").alias("shifts")))
    # the documents that are proposed, once each, laid on one item text a row
    found_in = rows.join(proposed.select("row", "row2").distinct(), ["row", "row2"], "left_semi").select("row", "row2", "text").dropDuplicates(["row", "row2"])
    laid = proposed.join(texts, "key").join(found_in.select("row", "row2", words_of(F.col("text")).alias("words")), ["row", "row2"])
    # where the item's windows that agree begin in the document
    starts = f"""flatten(transform(shifts, s -> transform(filter(
        sequence(0, size(item_words) - least({span}, size(item_words))),
        j -> s + j >= 0 AND s + j + least({span}, size(item_words)) <= size(words)
             AND slice(words, s + j + 1, least({span}, size(item_words))) = slice(item_words, j + 1, least({span}, size(item_words)))),
        j -> s + j)))"""
    agree = checkpointed(laid.select("row", "row2", "key", F.least(F.lit(span), n).alias("n"), F.expr(starts).alias("starts")).where(F.size("starts") > 0))
    places = agree.select("row", "row2", F.explode(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + F.col("n") - 1)))).alias("place")).distinct()
    hit = places.groupBy("row", "row2").agg(F.count("*").alias("n_hit"))
    listed = agree.select("row", "row2", "key").distinct().join(asked.select("key", "item").distinct(), "key").groupBy("row", "row2").agg(F.array_sort(F.collect_set("item")).alias("items"))
    all_rows = rows.select("id", "row", "row2", F.size(words_of(F.col("text"))).cast("long").alias("n_words"), *more)
    found = all_rows.join(hit.join(listed, ["row", "row2"], "left"), ["row", "row2"], "left")
    return found.select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        *([F.col("own").alias(text_col), "carry"] if carry else []),
    ).withColumn("contaminated", F.col("n_hit") > 0)


def oracle(span: int = 10) -> str:
    """SQL for the rows of the query, by comparing all windows."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS ws FROM documents),
    b AS (SELECT item_id, ws, least(len(ws), {span}) AS n FROM (SELECT item_id, {words} AS ws FROM benchmark) WHERE len(ws) > 0),
    bw AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM (SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM b)),
    dw AS (SELECT rid, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM b) WHERE len(ws) >= n)),
    m AS (SELECT rid, item_id, n, i FROM dw JOIN bw USING (n, g)),
    h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM m) GROUP BY rid),
    t AS (SELECT rid, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM m) GROUP BY rid)
    SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)"""
