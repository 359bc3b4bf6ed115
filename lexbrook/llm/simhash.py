"""SimHash fingerprints and near-duplicate groups by deletion-variant signatures.

Fingerprints of 64 bits are cut into segments. Two that differ in max_bits bits or fewer have, among
max_bits // 2 + 1 segments, one with one differing bit at most, so they agree in that segment with one bit
left out. Every fingerprint is indexed under each segment with each bit left out; an equality join by
such a place brings together all that may be linked, and those that meet are verified. Copies share a
fingerprint and meet as one.

Places are dealt out and sorted by Spark and read as a stream; all fingerprints of a place are compared
in blocks of numpy vectors, and only links that join two groups of the place are given out, so no place
emits all its pairs. A place of more than ``block`` fingerprints is split: its members are dealt into
blocks, and each two blocks meet in a task of their own, so no task holds more than about two blocks and
no pair is left out.

``near_duplicates`` links fingerprints by their bits. ``near_copies`` links texts whose sets of
shingles have a Jaccard of ``least`` or more: candidates come from the same index, cut as ``shape`` says,
and are compared exactly on the whole sets, family by family.

Defined results: null is treated as the empty text; a text without words has fingerprint zero and is
linked like any other (near_copies: all texts without words are one group); with fewer words than a
shingle all words are one shingle. Whole texts are read; repeated shingles count in near_duplicates, once
in near_copies. Null ids never name a group unless it has no other. Repeated rows stay. Empty tables give
empty results. Columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, map_arrow, release_memory, rows_of
from .components import connected_components

BITS = 64
#: Shingles whose bits are counted at a time.
COUNTED = 1 << 14
#: Fingerprints of a place that are compared in one task; larger places are split.
BLOCK = 4096
#: Rows of places that a Python worker takes at a time.
HELD = 1 << 16
#: Bits of a second plane that are looked at beside a place's own.
CHECKED = 48
#: Steps of distance in which a place's groups are joined, the nearest first.
STEPS = 6
#: Shingles of the sets that one side of an exact comparison holds, about; larger families are compared in blocks, two at a time.
SHINGLES = 1 << 18
#: Crowded places that are broadcast at most; more of them are joined by a shuffle.
MOST_SENT = 100_000
M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def shingle_hashes(text: str | None, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle of words, repeats included."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes, lower() changes A-Z only
    if not w:
        return np.array([], np.uint64)
    h, join = xxhash.xxh64_intdigest, b" ".join
    return np.array([h(join(s), seed) for s in (zip(*(w[i:] for i in range(words))) if len(w) >= words else [w])], "<u8")


def sketch(hashes: np.ndarray, planes: int = 1) -> np.ndarray:
    """SimHash of the hashes, as so many 64-bit numbers; the first is of the hashes themselves, the others of hashes of them."""
    out = []
    for p in range(planes):
        ones = np.zeros(BITS, np.int64)
        for i in range(0, len(hashes), COUNTED):
            x = hashes[i : i + COUNTED]
            if p:
                x = (x + np.uint64(int(M1) * p % (1 << BITS))) * M2
                x = (x ^ (x >> np.uint64(27))) * M3
                x ^= x >> np.uint64(31)
            ones += np.unpackbits(x.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little"))
    return np.array(out, np.uint64)


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """The SimHash of the word shingles of a text, as an unsigned number."""
    return int(sketch(shingle_hashes(text, words, seed))[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """(id, fp, text_hash) for each row of docs; fp: the fingerprint's bits as a signed long, text_hash: XXH64 of the text."""

    def f(b: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t, words, seed) for t in b.column(1).to_pylist()], np.uint64)
        return pa.record_batch([pa.array(found.view(np.int64))], names=["fp"])

    rows = rows_of(docs, id_col, text_col).withColumn("carry", F.xxhash64("text"))
    return map_arrow(rows, lambda: f, "fp long").withColumnRenamed("carry", "text_hash")


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def segments(n: int) -> list[int]:
    """Masks of n nearly equal runs of bits."""
    cuts = [i * BITS // n for i in range(n + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]


def variants(n: int) -> list[int]:
    """For each of the 64 bits the mask of its segment without it."""
    return [signed(m & ~(1 << i)) for m in segments(n) for i in range(BITS) if m >> i & 1]


def partnered(size: np.ndarray, planes: list[np.ndarray], most: int) -> np.ndarray:
    """Whether each row has another one in its place, from which its planes differ in ``most`` bits or fewer together. Rows are sorted
    by place; size: rows of each place.

    Places of like sizes are the columns of a matrix, so all pairs of a distance are compared in one pass over neighbouring numbers.
    """
    out = np.zeros(int(size.sum()), bool)
    start = np.cumsum(size) - size
    order = np.argsort(size, kind="stable")
    sizes = size[order]
    at = int(np.searchsorted(sizes, 2))
    while at < len(order):
        upto = int(np.searchsorted(sizes, sizes[at] + sizes[at] // 4, "right"))
        chosen, width = order[at:upto], int(sizes[upto - 1])
        n, own = len(chosen), size[chosen]
        row = np.arange(width)[:, None]
        filled = row < own
        index = np.where(filled, start[chosen] + row, 0)
        blank = np.random.default_rng(width).integers(0, 1 << 63, (len(planes), width, n), np.uint64)  # unlike each other; told from rows below
        flat = [np.where(filled, x[index], y).ravel() for x, y in zip(planes, blank, strict=True)]
        for d in range(1, width):
            differ = np.bitwise_count(flat[0][d * n :] ^ flat[0][: -d * n])
            for x in flat[1:]:
                differ += np.bitwise_count(x[d * n :] ^ x[: -d * n])
            hit = np.flatnonzero(differ <= most)
            hit = hit[hit // n + d < own[hit % n]]
            first = index.ravel()[hit]
            out[first] = out[first + d] = True
        at = upto
    return out


def linked(place: np.ndarray, planes: list[np.ndarray], key: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of keys (a, b) of the same place whose planes differ in ``most`` bits or fewer together: those that join two groups
    of the place, after which these are one, nearer pairs first. Rows are sorted by place.

    All pairs are compared once; groups are then joined among the rows that have a partner, which are few in places where chance brought rows together.
    """
    for narrowed in (False, True):
        n = len(place)
        start = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if n else np.zeros(0, np.int64)
        size = np.diff(np.r_[start, n])
        if not narrowed:
            rows = np.flatnonzero(partnered(size, planes, most))
            place, planes, key = place[rows], [x[rows] for x in planes], key[rows]
    of = np.repeat(np.arange(len(start)), size)
    left = (start + size)[of] - np.arange(n) if n else start  # rows of the place from here on, this one included
    label = np.arange(n)

    def near(rows: np.ndarray, limit: int) -> Iterator[tuple[int, np.ndarray]]:
        """By distance in the table, the rows whose partner that far on is within the limit and has another label."""
        for d in range(1, int(size.max(initial=1))):
            rows = rows[left[rows] > d]
            other = rows[(label[rows] != label[rows + d]) & (key[rows] != key[rows + d])]
            differ = np.zeros(len(other), np.int64)
            for x in planes:
                differ += np.bitwise_count(x[other] ^ x[other + d])
            yield d, other[differ <= limit]

    for step in range(1, STEPS + 1) if most >= STEPS * 2 else [STEPS]:
        for d, found in near(np.flatnonzero(left > 1), most * step // STEPS):
            kept = []
            for i in found.tolist():
                a, b = label[i], label[i + d]
                if a != b:
                    k = of[i]
                    own = label[start[k] : start[k] + size[k]]
                    own[own == max(a, b)] = min(a, b)
                    kept.append(i)
            if kept:
                at = np.array(kept, np.int64)
                yield key[at], key[at + d]


def crowded_places(nodes: DataFrame, planes: int, cut: int, block: int) -> DataFrame:
    """(slot, rest, blocks) of places that may hold more than ``block`` nodes.

    A place holds the nodes of two values of its segment, so one of them has more than half a block; values are counted, not places.
    """
    masks = segments(cut)
    every = [F.struct(F.lit(p * cut + k).alias("segment"), F.get("planes", F.lit(p)).bitwiseAND(F.lit(signed(m))).alias("value")) for p in range(planes) for k, m in enumerate(masks)]
    values = nodes.select(F.explode(F.array(*every)).alias("v")).groupBy("v.segment", "v.value").agg(F.count("*").alias("n")).where(F.col("n") > block / 2)
    bits = F.lit([[i for i in range(BITS) if m >> i & 1] for m in masks])
    at = values.withColumn("bit", F.explode(F.element_at(bits, F.col("segment") % cut + 1)))
    slot = F.floor(F.col("segment") / cut).cast("int") * BITS + F.col("bit")
    rest = F.col("value").bitwiseAND(F.expr("~shiftleft(1L, bit)"))
    return at.select(slot.alias("slot"), rest.alias("rest"), "n").groupBy("slot", "rest").agg(F.ceil(2 * F.max("n") / block).cast("int").alias("blocks"))


def meet(nodes: DataFrame, planes: int, cut: int, most: int, block: int = BLOCK) -> DataFrame:
    """(a, b): pairs of keys that meet at a place and differ in ``most`` of the bits looked at or fewer (see ``linked``).

    nodes: (key, planes array<long>). A row for each plane and bit left out holds that plane, the key and, if there are
    more planes, CHECKED bits of the next one, which are looked at as well.
    """
    masks = F.lit(variants(cut))
    plane = F.floor(F.col("slot") / BITS).cast("int")
    every = nodes.select("key", "planes", F.explode(F.sequence(F.lit(0), F.lit(planes * BITS - 1))).alias("slot"))
    check = F.get("planes", (plane + 1) % planes) if planes > 1 else F.lit(0).cast("long")
    tag = F.shiftleft(check, BITS - CHECKED).bitwiseOR(F.col("slot"))
    rows = every.select(tag.alias("tag"), F.get("planes", plane).alias("x"), "key")
    slot = F.col("tag").bitwiseAND((1 << BITS - CHECKED) - 1).cast("int")
    rest = F.col("x").bitwiseAND(F.element_at(masks, slot % BITS + 1))
    crowded = checkpointed(crowded_places(nodes, planes, cut, block))
    pair = F.lit(0)
    if n := crowded.count():
        placed = rows.withColumns({"slot": slot, "rest": rest}).join(F.broadcast(crowded) if n <= MOST_SENT else crowded, ["slot", "rest"], "left")
        own = F.pmod(F.xxhash64("key"), "blocks").cast("int")
        pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda q: F.least(own, q) * F.col("blocks") + F.greatest(own, q))
        rows = placed.select(*rows.columns, F.explode(F.when(F.col("blocks") > 1, pairs).otherwise(F.array(F.lit(0)))).alias("pair"))
        pair = F.col("pair")
    names = [c for c in rows.columns if c not in ("tag", "pair")]
    dealt = rows.repartition(slot, rest, pair).select(slot.alias("slot"), rest.alias("rest"), pair.alias("pair"), "tag", *names).sortWithinPartitions("slot", "rest", "pair")

    def run(batches):
        held: list[pa.RecordBatch] = []
        n_held = 0

        def found(t: pa.Table):
            slot, rest, pair, tag, x, key = (t.column(i).to_numpy() for i in range(t.num_columns))
            place = np.cumsum(np.r_[False, (slot[1:] != slot[:-1]) | (rest[1:] != rest[:-1]) | (pair[1:] != pair[:-1])])
            looked = [x.view(np.uint64), *([tag.view(np.uint64)] if planes > 1 else [])]  # the slots of a place are equal
            for a, b in linked(place, looked, key, most):
                yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for b in batches:
            held.append(b)
            n_held += b.num_rows
            if n_held < HELD:
                continue
            t = pa.Table.from_batches(held)
            ends = [t.column(i).to_numpy() for i in range(3)]
            last = np.flatnonzero(np.logical_or.reduce([x != x[-1] for x in ends]))
            cut_at = int(last[-1]) + 1 if len(last) else 0  # the last place may go on in the next batch
            if cut_at:
                yield from found(t.slice(0, cut_at))
            held, n_held = t.slice(cut_at).combine_chunks().to_batches(), t.num_rows - cut_at
        if n_held:
            yield from found(pa.Table.from_batches(held))
        held.clear()
        release_memory()

    return dealt.mapInArrow(run, "a long, b long").distinct()


def links(distinct: DataFrame, max_bits: int, block: int = BLOCK) -> DataFrame:
    """(a, b): edges between different fingerprints (fp) whose components are those of all links of max_bits."""
    if max_bits < 1:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    return meet(distinct.select(F.col("fp").alias("key"), F.array("fp").alias("planes")), 1, max_bits // 2 + 1, max_bits, block)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = 4, seed: int = 42, block: int = BLOCK) -> DataFrame:
    """(id, fingerprint, component_id, group, text_hash) for each row of docs; component_id: the least id in its group.

    block only bounds what a task holds, it never changes results.
    """
    prints = checkpointed(fingerprints(docs, id_col, text_col, words, seed))
    nodes = checkpointed(prints.groupBy("fp").agg(F.min("id").alias("first")))
    roots = connected_components(links(nodes.select("fp"), max_bits, block))
    rooted = checkpointed(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    named = checkpointed(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    groups = checkpointed(rooted.join(named, "root").select("fp", "root", "component_id"))
    out = prints.join(groups, "fp", "left")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", F.col("root").alias("group"), "text_hash")


def share_of_bits(jaccard: float) -> float:
    """The share of bits in which SimHashes of two sets of equal size differ, on average."""
    return math.acos(2 * jaccard / (1 + jaccard)) / math.pi


def shape(n: int, least: float, recall: float = 0.999, block: int = BLOCK) -> tuple[int, int]:
    """(planes, segments of a plane) for n different texts: segments so long that chance brings no more than a
    block to a place, and planes so many that a pair of Jaccard ``least`` meets with probability ``recall`` or more.

    A pair meets in a segment of b bits if it differs there in one bit or none: (1 - p)^b + b p (1 - p)^(b - 1). Segments never get
    longer than a third of a plane: beyond that (some 5 * 10^9 texts) places hold more than a block and are split, as crowded ones
    are at any size.
    """
    cut = next((c for c in (5, 4) if n / 2 ** (BITS / c - 1) <= block), 3)
    p, b = share_of_bits(least), BITS / cut
    meets = (1 - p) ** b + b * p * (1 - p) ** (b - 1)
    return math.ceil(math.log(1 - recall) / math.log(1 - meets) / cut), cut


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, least: float = 0.8, recall: float = 0.999, block: int = BLOCK, shingles_in_block: int = SHINGLES, cut: tuple[int, int] | None = None) -> DataFrame:
    """(id, group, text_hash) for each row of docs; group is the same just for rows that are linked.

    Candidates are pairs that meet in the index and differ in no more bits than pairs of Jaccard ``least`` do but for one in ten
    thousand; candidates that are connected form a family. Sets of a family's texts meet in one task (of a family of more than
    ``shingles_in_block`` shingles in blocks, each two of them in a task of its own) and are compared there exactly, so what
    leaves a task is only what joins two groups, and a task holds the shingles of two blocks, or of one longer text.
    ``recall`` is that a pair of just ``least`` meets; likelier pairs are found more surely. cut: (planes, segments of each), by
    default as ``shape`` says.
    """

    def printed(planes: int):
        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            sets = [np.unique(shingle_hashes(t, words)) for t in b.column(1).to_pylist()]
            keys = np.array([xxhash.xxh64_intdigest(h.tobytes()) for h in sets], np.uint64)
            found = pa.array([sketch(h, planes).view(np.int64) for h in sets], pa.list_(pa.int64()))
            return pa.record_batch([pa.array(keys.view(np.int64)), pa.array(list(map(len, sets)), pa.int32()), found], names=["key", "n", "planes"])

        return f

    def listed(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = [np.unique(shingle_hashes(t, words)) for t in b.column(1).to_pylist()]
        keys = np.array([xxhash.xxh64_intdigest(h.tobytes()) for h in sets], np.uint64)
        return pa.record_batch([pa.array(keys.view(np.int64)), pa.array([h.view(np.int64) for h in sets], pa.list_(pa.int64()))], names=["key", "shingles"])

    rows = rows_of(docs, id_col, text_col).withColumn("carry", F.xxhash64("text"))
    planes, segs = cut or shape(docs.count(), least, recall, block)
    prints = checkpointed(map_arrow(rows, lambda: printed(planes), "key long, n int, planes array<long>").withColumnRenamed("carry", "text_hash"))
    nodes = checkpointed(prints.groupBy("key").agg(F.min("n").alias("n"), F.min("text_hash").alias("text_hash"), F.first("planes").alias("planes")).where("n > 0"))
    looked = BITS + CHECKED * (planes > 1)
    p = share_of_bits(least)
    most = math.ceil(p * looked + 3.72 * math.sqrt(p * (1 - p) * looked))
    whole = BITS * planes
    most_in_all = math.ceil(p * whole + 3.72 * math.sqrt(p * (1 - p) * whole))

    def alike(pairs: DataFrame) -> DataFrame:
        """The pairs that are near in all planes; this leaves nearly none that met by chance, so few sets are compared."""
        x, y = (nodes.select(F.col("key").alias(k), F.col("planes").alias(f"p_{k}")) for k in "ab")
        differ = F.aggregate(F.zip_with("p_a", "p_b", lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda n, d: n + d)
        return pairs.join(x, "a").join(y, "b").where(differ <= most_in_all).select("a", "b")

    tried = checkpointed(alike(meet(nodes, planes, segs, most, block)))
    families = checkpointed(connected_components(tried).select(F.col("node").alias("key"), F.col("root").alias("family")))
    sized = families.join(nodes.select("key", "n", "text_hash"), "key")
    blocks = checkpointed(sized.groupBy("family").agg(F.ceil(F.sum("n") / shingles_in_block).cast("int").alias("blocks")))
    members = checkpointed(sized.drop("n").join(blocks, "family"))
    shown = members.select(F.col("text_hash").alias("carry")).distinct()
    texts = rows.join(F.broadcast(shown) if members.count() <= MOST_SENT else shown, "carry", "left_semi").select("id", "text", "carry").dropDuplicates(["carry"])
    sets = map_arrow(texts, lambda: listed, "key long, shingles array<long>").select("key", "shingles").dropDuplicates(["key"])
    own = F.pmod(F.xxhash64("key"), "blocks").cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda q: F.least(own, q) * F.col("blocks") + F.greatest(own, q))
    met = members.join(sets, "key").select("family", F.explode(pair).alias("pair"), "key", "shingles")
    links = checkpointed(met.groupBy("family", "pair").applyInArrow(lambda t: joined(t, least), "a long, b long").distinct())
    roots = connected_components(links).withColumnRenamed("node", "key")
    return prints.join(roots, "key", "left").select(F.col("id").alias(id_col), F.coalesce("root", "key").alias("group"), "text_hash")


def joined(met: pa.Table, least: float) -> pa.Table:
    """Links (a, b) between sets (key, shingles): enough to join all that have a pair of a Jaccard of ``least`` or more.

    A set is counted against those behind it that it is not joined with yet and whose size allows it: by way of the owners of its
    shingles, or through their own shingles, whichever are fewer. Near copies join at once, so most of a family is counted once.
    """
    keys = met["key"].to_numpy()
    lists = met["shingles"].combine_chunks()
    sizes = lists.value_lengths().to_numpy().astype(np.int64)
    words = np.unique(lists.flatten().to_numpy(), return_inverse=True)[1]
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(words, kind="stable")  # so owners of a shingle stand in order
    owner, cuts = np.repeat(np.arange(len(keys)), sizes)[order], np.searchsorted(words[order], np.arange(words.max(initial=-1) + 2))
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))  # where each shingle of each set stands among its owners
    label, marked = np.arange(len(keys)), np.zeros(len(cuts), bool)

    def all_of(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The places of all ranges of n from begin on."""
        return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())

    found: list[tuple[int, int]] = []
    for i in range(len(keys) - 1):
        behind = np.arange(i + 1, len(keys))
        fits = np.minimum(sizes[behind], sizes[i]) >= least * np.maximum(sizes[behind], sizes[i])
        others = behind[fits & (label[behind] != label[i])]
        if not len(others):
            continue
        own = slice(starts[i], starts[i] + sizes[i])
        begin, n = place[own] + 1, cuts[words[own] + 1] - place[own] - 1  # the owners behind this set
        if n.sum() <= sizes[others].sum():
            shared = np.bincount(owner[all_of(begin, n)], minlength=len(keys))[others]
        else:
            marked[words[own]] = True
            shared = np.add.reduceat(marked[words[all_of(starts[others], sizes[others])]].astype(np.int64), np.cumsum(sizes[others]) - sizes[others])
            marked[words[own]] = False
        for j in others[shared >= least * (sizes[i] + sizes[others] - shared)].tolist():
            a, b = label[i], label[j]
            if a != b:
                label[label == max(a, b)] = min(a, b)
                found.append((int(min(keys[i], keys[j])), int(max(keys[i], keys[j]))))
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs without near copies: of each group of near_copies the one of least id (of equal ids, of
    the least text hash; a null id only in a group without another). All columns stay."""
    return one_of_each(docs, near_copies(docs, id_col, text_col, **options), id_col, text_col)


def one_of_each(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The row of docs that stays of each group of found (id, group, text_hash)."""
    least = found.groupBy("group").agg(F.min(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), "text_hash")).alias("x"))
    chosen = least.select(F.col("x.id").alias("_id"), F.col("x.text_hash").alias("_hash"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("carry"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("hash"))
    kept = rows.join(chosen, rows["id"].eqNullSafe(chosen["_id"]) & (rows["hash"] == chosen["_hash"]), "left_semi")
    return kept.dropDuplicates(["id", "hash"]).select("carry.*")
