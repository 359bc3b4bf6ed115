"""SpotSigs: fingerprints of documents from spots of content words behind common words.

A spot starts at an anchor (a common word, the start of a line, or a content word whose own hash is 0 modulo
OWN_STARTS, so that texts in which common words are rare or unknown have spots all over, too) and takes the
next ``chain`` content words, words that are not anchors, wherever they stand further on in the text
(fewer at its end). The fingerprint is the set of the spots' 32-bit hashes, written in hex and
sorted, so it can be compared as it is. Two sets can only have a Jaccard of t or more if the smaller
one has t times the larger one's size; the join deals sets out by ranges of size that follow from
this, and looks only at spots among the rarest of each set.

Defined results: null is treated as the empty text, whose fingerprint is ''; two empty fingerprints
are alike (1.0), an empty and another one are not (0.0). A text without any letter or digit is
cut at white space instead. Equal texts have equal fingerprints, so ties and repeated rows are alike. Whole
texts are read; an empty table gives no rows. Ids may be of any type that can be sorted; null ids come last.
Columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import checkpointed, map_arrow, rows_of

#: Common words of the languages served, the anchors of spots.
ANCHORS = frozenset(
    "the of and to a in is it that was for on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than been its who now people my made over did down only way find use may you he i"
    " der die das und ist nicht ein eine einen einem einer des dem den zu mit von auf für im an als auch es sich bei nach wie aus um dass sie er wir ihr"
    " le la les un une de du et est que qui dans pour pas sur au aux par avec ce il elle ne se plus sont en"
    " el los las una del y en que es por con para no se su al lo como más".split()
)
WORD = re.compile(r"\n|\w+")
HASH_DIGITS = 8
#: One content word in so many starts a spot of its own.
OWN_STARTS = 16


def spots(text: str, chain: int = 2, anchors: frozenset[str] = ANCHORS) -> set[str]:
    content: list[str] = []
    starts: list[tuple[str, int]] = [("", 0)]
    for w in WORD.findall(text.lower()):
        if w in anchors:
            starts.append((w, len(content)))
        elif w == "\n":
            starts.append(("", len(content)))
        else:
            if crc32(w.encode("utf-8", "surrogatepass")) % OWN_STARTS == 0:
                starts.append((w, len(content) + 1))
            content.append(w)
    if not content:
        words = [w for w in WORD.findall(text.lower()) if w != "\n"] or text.split()
        return {" ".join(words[i : i + chain]) for i in range(len(words))}
    if chain == 2:
        nexts = [a + " " + b for a, b in zip(content, content[1:])] + content[-1:]
    else:
        nexts = [" ".join(content[i : i + chain]) for i in range(len(content))]
    n = len(nexts)
    return {a + ":" + nexts[i] for a, i in starts if i < n}


def signature(text: str | None, chain: int = 2) -> np.ndarray:
    """Sorted distinct hashes of the text's spots."""
    h = xxhash.xxh32_intdigest
    return np.unique(np.array([h(s) for s in spots(text or "", chain)], np.uint32))


def as_text(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard of two sorted sets; 0 where the sizes alone, or what is left to compare, rule out ``least``."""
    if not len(a) and not len(b):
        return 1.0
    if not len(a) or not len(b) or min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    found = both / (len(a) + len(b) - both)
    return found if found >= least else 0.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chain: int = 2) -> DataFrame:
    """(id, fingerprint, n_spots) for each row of docs."""

    def f(b: pa.RecordBatch) -> pa.RecordBatch:
        sigs = [signature(t, chain) for t in b.column(1).to_pylist()]
        return pa.record_batch([pa.array(map(as_text, sigs), pa.string()), pa.array(map(len, sigs), pa.int64())], names=["fingerprint", "n_spots"])

    return map_arrow(rows_of(docs, id_col, text_col), lambda: f, "fingerprint string, n_spots long").withColumnRenamed("id", id_col)


def near_duplicates(prints: DataFrame, least: float = 0.8, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Pairs of different fingerprints with a Jaccard of ``least`` or more, and who has which.

    Returns (fingerprint_a, fingerprint_b, likeness) with a < b, and (id, fingerprint): copies meet
    once. Sets are dealt out by ranges of size, each range and the next, and joined there on spots
    among their rarest ones; frequencies are counted over all sets.
    """
    members = prints.select(id_col, "fingerprint")
    sets = checkpointed(
        prints.select("fingerprint").distinct().where("fingerprint <> ''")
        .withColumn("n", (F.length("fingerprint") / HASH_DIGITS).cast("int"))
        .withColumn("spots", F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.substring("fingerprint", i * HASH_DIGITS + 1, F.lit(HASH_DIGITS))))
        .withColumn("key", F.xxhash64("fingerprint"))
    )
    spot = sets.select("key", "n", F.explode("spots").alias("spot"))
    df = spot.groupBy("spot").agg(F.count("*").alias("df"))
    # the set's rarest spots: of two alike sets one must share one of so many
    ranked = spot.join(df, "spot").groupBy("key", "n").agg(F.array_sort(F.collect_list(F.struct("df", "spot"))).alias("s"))
    prefix = F.col("n") - F.ceil(F.col("n") * least).cast("int") + 1
    # size classes grow by 1/least, so partners are in the same or the next one
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / least)) + 1e-9).cast("int") if least < 1 else F.col("n")
    keyed = ranked.select("key", "n", size_class.alias("class"), F.explode(F.slice("s", 1, prefix)).alias("s")).select("key", "n", "class", F.col("s.spot").alias("spot"))
    left = keyed.select(F.col("key").alias("a"), F.col("n").alias("na"), F.explode(F.array(F.col("class"), F.col("class") + 1)).alias("class"), "spot")
    right = keyed.select(F.col("key").alias("b"), F.col("n").alias("nb"), "class", "spot")
    fits = (F.least("na", "nb") >= F.greatest("na", "nb") * least - 1e-9) & ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
    pairs = left.join(right, ["class", "spot"]).where(fits).select("a", "b").distinct()
    x, y = (sets.select(F.col("key").alias(k), F.col("fingerprint").alias(f"fingerprint_{k}"), F.col("spots").alias(f"spots_{k}")) for k in "ab")
    both = pairs.join(x, "a").join(y, "b").withColumn("shared", F.size(F.array_intersect("spots_a", "spots_b")))
    found = both.withColumn("likeness", F.col("shared") / (F.size("spots_a") + F.size("spots_b") - F.col("shared"))).where(F.col("likeness") >= least)
    p, q = F.least("fingerprint_a", "fingerprint_b"), F.greatest("fingerprint_a", "fingerprint_b")
    return found.select(p.alias("fingerprint_a"), q.alias("fingerprint_b"), "likeness"), members


def with_next(docs: DataFrame, ranges: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """Rows (part, id, text, borrowed) dealt out so that each range of ids, read in descending order,
    ends with a borrowed copy of the first row of the next range (of the first range, after the last); and the number of ranges.

    Texts move once. Spark cuts the ids into ranges; only the first id of each is collected. Null ids come last.
    """
    sc = docs.sparkSession.sparkContext
    ids = docs.select(F.col(id_col).alias("id")).where("id IS NOT NULL").repartitionByRange(ranges, F.col("id").desc())
    firsts = sorted(r["first"] for r in ids.groupBy(F.spark_partition_id().alias("part")).agg(F.max("id").alias("first")).collect())
    parts = max(1, len(firsts))
    sent = sc.broadcast(firsts)

    @F.arrow_udf("array<int>")
    def places(ids: pa.Array) -> pa.Array:
        """The part of each id, and the part that borrows the row if the id is its part's first."""
        known = sent.value
        there = ids.is_valid().to_numpy(zero_copy_only=False)
        k = np.zeros(len(ids), np.int64)  # null ids are in the last part, that of the least ids
        first = np.full(len(ids), not known)
        if known:
            values = ids.drop_null().to_numpy(zero_copy_only=False)
            table = np.array(known, dtype=values.dtype)
            k[there] = np.searchsorted(table, values)
            first[there] = table[k[there]] == values
        own, lent = len(known) - 1 - k if known else k, (len(known) - 2 - k) % parts if known else k
        ends = np.cumsum(np.r_[0, 1 + first]).astype(np.int32)
        flat = np.empty(ends[-1], np.int32)
        flat[ends[:-1]] = own
        flat[ends[1:][first] - 1] = lent[first]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.select("id", "text", F.posexplode(places("id")).alias("borrowed", "part")).select("part", "id", "text", (F.col("borrowed") > 0).alias("borrowed")), parts


def edited(text: str, other: str) -> str:
    """The text with its last half replaced by the first as many code points of the other."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def edit_likeness(docs: DataFrame, ranges: int | None = None, id_col: str = "doc_id", text_col: str = "text", chain: int = 2) -> DataFrame:
    """For each document: its fingerprint, its edited text's (see ``edited``; the other is the next
    document in descending order of ids, the first after the last), and how alike its own is to the
    edited one's and to the next document's. Repeated ids stand in the order of their texts."""
    rows, parts = with_next(docs, ranges or max(8, docs.select(id_col).rdd.getNumPartitions()), id_col, text_col)
    dealt = rows.repartitionById(parts, "part").sortWithinPartitions("part", "borrowed", F.col("id").desc_nulls_last(), "text")

    def run(batches):
        held = None  # (part, id, text, signature) waiting for the next row

        def give(out, row, nxt_text, nxt_sig):
            _, i, text, sig = row
            changed = edited(text, nxt_text)
            other = signature(changed, chain)
            out.append((i, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), as_text(sig), as_text(other), jaccard(sig, other), jaccard(sig, nxt_sig)))

        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b, out = whole.slice(k, 500), []
                for part, i, text, borrowed in zip(*(c.to_pylist() for c in b.columns)):
                    text = text or ""
                    if borrowed and held is None:
                        continue  # further rows with the borrowed id
                    sig = signature(text, chain)
                    if held is not None:
                        give(out, held, text, sig)
                    held = None if borrowed else (part, i, text, sig)
                columns = list(zip(*out)) or [[]] * 7
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))], names=names)

    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.mapInArrow(run, schema).withColumnRenamed("id", id_col)
