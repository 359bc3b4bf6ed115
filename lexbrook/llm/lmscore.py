"""Language-model scores from a log-frequency Bloom filter.

Counts of unigrams and bigrams of training texts are quantised, q = 1 + floor(log_base(count)), and the
pairs (gram, 1) ... (gram, q) are put in a Bloom filter. A gram's count is read back by asking for
(gram, 1), (gram, 2) and so on until one is missing. The probability of a word is smoothed towards that
of the word alone: p(w|h) = (c(h w) + mu p(w)) / (c(h) + mu), with c(h w) taken at the lower end of its
step and c(h) at the upper end, p(w) = (c(w) + 1) / (N + V + 1). mu = MU c(h) ** POWER follows the number of
different words seen after h, which grows like a power of its count.

The filter is made of shards by the grams' hashes, each built in a task of its own from a bounded share of
the corpus and sized for its own grams, so it grows with the corpus. Bigrams' shards are broadcast
in passes of ``pass_bytes`` at most; the driver holds one pass at a time, and each is let go before the next. A
pass scores the tokens whose bigram falls in its shards; the passes' sums add up to the text's score. The
unigrams' filter goes along with all passes: it grows with the vocabulary, by about 1.5 to 3 bytes a word,
and is the one thing here that is sent whole without a fixed bound.

Exact unigram scores come beside it: counts of the ``heavy`` most frequent words are broadcast (a bounded
table), the other words of a document are joined with their counts by hash.

Words are told apart by 64-bit hashes. Defined results: null is treated as the empty text, which is
one end token; without training texts every word is unknown (N = V = 0). Rows that share id and
text have equal results and all stay; an empty table gives no rows. Texts are read whole. Which rows
teach is the caller's choice; rows with a null id teach like others if they are in ``train``. Other
columns are not looked at.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, pieces

END = b"\n"  # no word holds white space
START = b"\n\n"
BASE, BITS_SET, BITS_PER_ENTRY = 1.5, 5, 9.0
MU, POWER = 3.0, 0.9
LEVELS = 96
#: Characters of text whose grams one shard holds, and shards' bytes sent at once.
SHARD_CHARS, PASS_BYTES = 8_000_000, 128 << 20
#: Bytes of text that a Python worker cuts into words at a time.
PIECE = 3 << 20
HEAVY = 500_000
M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def bigram(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * M1 + word)


def quantised(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log_BASE(count)) for counts of 1 and more."""
    return (1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9)).astype(np.int64)


START_HASH = np.uint64(xxhash.xxh64_intdigest(START))
END_HASH = np.uint64(xxhash.xxh64_intdigest(END))


class Tokens:
    """The tokens of some texts in a row: distinct hashes, each token's index in them, where texts begin."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))  # A-Z only; at either end of a text there may be empty words
        flat = lists.flatten()
        kept = pc.binary_length(flat).to_numpy() > 0
        row = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy())[kept]
        words = flat.filter(pa.array(kept)).dictionary_encode()
        known = [END, *words.dictionary.cast(pa.binary()).to_pylist()]
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))
        self.sizes = np.bincount(row, minlength=len(texts)) + 1
        self.starts = np.r_[0, np.cumsum(self.sizes)]
        inside = np.ones(self.starts[-1], bool)
        inside[self.starts[1:] - 1] = False
        self.index = np.zeros(self.starts[-1], np.int64)
        self.index[inside] = words.indices.to_numpy() + 1

    def bigrams(self) -> np.ndarray:
        h = self.hashes[self.index]
        before = np.empty_like(h)
        before[1:] = h[:-1]
        before[self.starts[:-1]] = START_HASH
        return bigram(before, h)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def count_words(texts: DataFrame) -> DataFrame:
    """(h, c): tokens' hashes and counts over all texts."""

    def run(batches):
        for b in pieces(batches, "text", PIECE):
            t = Tokens(b.column(0))
            yield pa.record_batch([pa.array(t.hashes.view(np.int64)), pa.array(np.bincount(t.index, minlength=len(t.hashes)))], names=["h", "c"])

    counted = texts.select("text").mapInArrow(run, "h long, c long").where("c > 0")
    return counted.groupBy("h").agg(F.sum("c").alias("c"))


def entry_place(h: np.ndarray, level: int, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the entries (gram, level): which of a shard's 64-bit words, and which of its bits."""
    x = mix(h + M1 * np.array([level], np.uint64))
    at = ((x >> np.uint64(32)) * words.astype(np.uint64)) >> np.uint64(32)
    one, bits = np.uint64(1), np.zeros(len(x), np.uint64)
    for i in range(BITS_SET):
        bits |= one << ((x >> np.uint64(6 * i)) & np.uint64(63))
    return at, bits


def build_shard(h: np.ndarray, q: np.ndarray) -> np.ndarray:
    words = np.zeros(max(1, math.ceil(int(q.sum()) * BITS_PER_ENTRY / 64)), np.uint64)
    for level in range(1, int(q.max(initial=0)) + 1):
        at, bits = entry_place(h[q >= level], level, np.array([len(words)]))
        np.bitwise_or.at(words, at, bits)
    return words


def build_filter(texts: DataFrame, counts: DataFrame, shards: int) -> DataFrame:
    """(kind, shard, bits): the filters of unigrams (kind 0) and bigrams (kind 1) of texts, checkpointed."""

    def frame(kind: int, h: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        place = (h % np.uint64(shards)).astype(np.int32) * 2 + kind
        return pa.record_batch([pa.array(place), pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], names=["place", "h", "c"])

    def bigrams(batches):
        for b in pieces(batches, "text", PIECE):
            yield frame(1, *np.unique(Tokens(b.column(0)).bigrams(), return_counts=True))

    starts = counts.where(F.col("h") == int(END_HASH.astype(np.int64))).select(F.lit(int(START_HASH.astype(np.int64))).alias("h"), "c")  # as many as ends

    def unigrams(batches):
        for b in batches:
            yield frame(0, mix(b.column(0).to_numpy().view(np.uint64)), b.column(1).to_numpy())

    def build(batches):
        held: dict[int, list] = {}
        for b in batches:
            place, h, c = (b.column(i).to_numpy() for i in range(3))
            order = np.argsort(place, kind="stable")
            place, h, c = place[order], h[order], c[order]
            cuts = np.flatnonzero(np.r_[True, place[1:] != place[:-1], True]) if len(place) else []
            for i, j in zip(cuts, cuts[1:]):
                held.setdefault(int(place[i]), []).append((h[i:j], c[i:j]))
        for p in list(held):
            parts = held.pop(p)
            h, back = np.unique(np.concatenate([x for x, _ in parts]).view(np.uint64), return_inverse=True)
            c = np.bincount(back, weights=np.concatenate([x for _, x in parts]))
            bits = build_shard(h, np.minimum(quantised(c), LEVELS))
            yield pa.record_batch([pa.array([p % 2], pa.int32()), pa.array([p // 2], pa.int32()), pa.array([bits.tobytes()], pa.binary())], names=["kind", "shard", "bits"])

    schema = "place int, h long, c long"
    found = texts.select("text").mapInArrow(bigrams, schema).unionByName(counts.select("h", "c").unionByName(starts).mapInArrow(unigrams, schema))
    # both filters of a shard are one task's
    return checkpointed(found.repartitionById(shards, F.floor(F.col("place") / 2).cast("int")).mapInArrow(build, "kind int, shard int, bits binary"))


class Filter:
    """Some shards' words in a row; grams of other shards have level 0."""

    def __init__(self, shards: int, sizes: dict[int, int]):
        self.shards = shards
        self.offset, self.size = np.zeros(shards, np.int64), np.zeros(shards, np.int64)
        at = 0
        for s in sorted(sizes):
            self.offset[s], self.size[s] = at, sizes[s]
            at += sizes[s]
        self.words = np.zeros(max(1, at), np.uint64)

    def put(self, shard: int, bits: bytes) -> None:
        self.words[self.offset[shard] : self.offset[shard] + self.size[shard]] = np.frombuffer(bits, np.uint64)

    def holds(self, h: np.ndarray) -> np.ndarray:
        return self.size[(h % np.uint64(self.shards)).astype(np.int64)] > 0

    def levels(self, h: np.ndarray) -> np.ndarray:
        """How many levels of each gram are found, by asking for one after another."""
        out = np.zeros(len(h), np.uint8)
        shard = (h % np.uint64(self.shards)).astype(np.int64)
        left = np.flatnonzero(self.size[shard] > 0)
        h, offset, size = h[left], self.offset[shard[left]], self.size[shard[left]]
        for level in range(1, LEVELS + 1):
            if not len(left):
                break
            at, bits = entry_place(h, level, size)
            go = (self.words[offset + at.astype(np.int64)] & bits) == bits
            left, h, offset, size = left[go], h[go], offset[go], size[go]
            out[left] = level
        return out


LOW = np.r_[0.0, BASE ** np.arange(LEVELS)]  # least count of each level, 0 for none
HIGH = np.r_[0.0, np.maximum(BASE ** np.arange(1, LEVELS + 1), 1.0)]
MIDDLE = np.r_[0.0, np.sqrt(BASE ** np.arange(LEVELS) * np.maximum(1.0, np.ceil(BASE ** np.arange(1, LEVELS + 1)) - 1))]


#: By the levels of a context and of a pair: the context's count, and mu.
COUNTS = np.maximum(HIGH[:, None], LOW[None, :])
MUS = MU * np.maximum(COUNTS, 1.0) ** POWER


def log_probabilities(words: np.ndarray, befores: np.ndarray, pairs: np.ndarray, total: float, kinds: float) -> np.ndarray:
    """log10 p of each token from the levels of it, of the token before and of both."""
    alone = (MIDDLE + 1) / (total + kinds + 1)
    both = befores.astype(np.int64) * COUNTS.shape[1] + pairs
    return np.log10((LOW[pairs] + MUS.ravel()[both] * alone[words]) * (1 / (COUNTS + MUS)).ravel()[both])


def score(docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text", pass_bytes: int = PASS_BYTES, heavy: int = HEAVY) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) for each row of docs, from the texts of train."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    texts = _rows(train, id_col, text_col)
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(16, math.ceil(chars / SHARD_CHARS))

    counts = checkpointed(count_words(texts))
    step = F.floor(F.log(F.col("c").cast("double")) * 20)
    histogram = sorted((r["s"], r["low"], r["n"], r["c"]) for r in counts.groupBy(step.alias("s")).agg(F.min("c").alias("low"), F.count("*").alias("n"), F.sum("c").alias("c")).collect())
    total, kinds = sum(r[3] for r in histogram), sum(r[2] for r in histogram)
    least, taken = 1 << 62, 0  # words of this count and more are broadcast
    for _, low, n, _ in reversed(histogram):
        if taken + n > heavy:
            break
        least, taken = low, taken + n
    top = counts.where(F.col("c") >= least).toArrow()
    top_h, top_c = top.column("h").to_numpy(), top.column("c").to_numpy()
    order = np.argsort(top_h)
    top_sent = sc.broadcast((top_h[order], top_c[order]))

    built = build_filter(texts, counts, shards)
    sizes = sorted((r["kind"], r["shard"], r["n"]) for r in built.select("kind", "shard", F.length("bits").alias("n")).collect())
    passes: list[dict[int, int]] = [{}]
    room = pass_bytes
    for kind, s, n in sizes:
        if kind == 1:
            if n > room and passes[-1]:
                passes.append({})
                room = pass_bytes
            passes[-1][s] = n // 8
            room -= n

    def collected(kind: int, of: dict[int, int]) -> Filter:
        out = Filter(shards, of)
        if of:
            for r in built.where((F.col("kind") == kind) & F.col("shard").isin(list(of))).select("shard", "bits").toLocalIterator():
                out.put(r["shard"], r["bits"])
        return out

    alone = sc.broadcast(collected(0, {s: n // 8 for kind, s, n in sizes if kind == 0}))
    kind = docs.schema[id_col].dataType
    id_name = kind.simpleString()
    rows = _rows(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))

    def one_pass(sent, first: bool):
        def run(batches):
            single, f = alone.value, sent.value
            known, known_c = top_sent.value
            start_level = single.levels(mix(np.array([START_HASH])))
            for b in pieces(batches, "text", PIECE):
                t = Tokens(b.column(2))
                word = single.levels(mix(t.hashes))[t.index]
                before = np.empty_like(word)
                before[1:] = word[:-1]
                before[t.starts[:-1]] = start_level[0]
                pairs = t.bigrams()
                logs = log_probabilities(word, before, f.levels(pairs), total, kinds)
                if len(passes) > 1:
                    logs[~f.holds(pairs)] = 0.0
                cut = t.starts[:-1]
                columns = [np.add.reduceat(logs, cut)]
                if first:
                    signed = t.hashes.view(np.int64)
                    there, k = found_in(known, signed)
                    own = np.where(there, known_c[k] if len(known) else 0, 0)
                    columns += [t.sizes, np.add.reduceat((own > 0)[t.index], cut, dtype=np.int64), np.add.reduceat(np.log10(own + 1.0)[t.index], cut)]
                    # the rarer words of each text with their numbers, for a join with their exact counts
                    use = np.flatnonzero(~there[t.index])
                    row = np.searchsorted(t.starts, use, "right") - 1
                    pair, n = np.unique(row * len(signed) + t.index[use], return_counts=True)
                    ends = pa.array(np.searchsorted(pair // len(signed), np.arange(b.num_rows + 1)).astype(np.int32))
                    columns += [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (signed[pair % len(signed)], n.astype(np.int32))]
                yield pa.record_batch([b.column(0), b.column(1), *(c if isinstance(c, pa.Array) else pa.array(c) for c in columns)], names=["id", "th", "score", "n_tokens", "known", "log", "rare", "times"][: 2 + len(columns)])

        return run

    scored = []
    for i, part in enumerate(passes):
        sent = sc.broadcast(collected(1, part))
        schema = f"id {id_name}, th long, score double" + (", n_tokens long, known long, log double, rare array<long>, times array<int>" if i == 0 else "")
        # a few numbers and the rare words of a document; then the pass's shards are needed no more
        found = rows.select("id", "th", "text").mapInArrow(one_pass(sent, i == 0), schema).withColumn("idh", F.xxhash64("id"))
        scored.append(checkpointed(found.withColumn("row", F.monotonically_increasing_id()) if i == 0 else found))
        sent.destroy()
    out = scored[0]
    lower = out.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("h"), F.col("x.times").alias("n"))
    joined = lower.join(counts.where(F.col("c") < least), "h").groupBy("row").agg(F.sum("n").alias("rare_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("rare_log"))
    if scored[1:]:  # each copy of a row adds the same
        rest = reduce(lambda a, b: a.unionByName(b), scored[1:]).groupBy("idh", "th").agg((F.sum("score") / F.count("*") * len(scored[1:])).alias("more"))
        out = out.join(rest, ["idh", "th"]).withColumn("score", F.col("score") + F.col("more"))
    return out.join(joined, "row", "left").select(
        F.col("id").alias(id_col),
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("log") + F.coalesce("rare_log", F.lit(0.0)) - F.col("n_tokens") * math.log10(total + kinds + 1)).alias("base_score"),
        "score",
    )


def found_in(known: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes a sorted table has, and where."""
    if not len(known):
        return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
    k = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return known[k] == h, k
