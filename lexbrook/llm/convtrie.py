"""The prefix trie of conversations: which begin with the same turns, and what sharing them saves.

1. **Dictionary.** Each distinct turn (role, text) gets a number; from there on only numbers move. Turns are told apart by
   the SHA-256 of role and text, so texts are read once and never shuffled.
2. **Radix partitioning.** All conversations are the root's bucket. Bucket by bucket, all at once, conversations are dealt out
   by their next turn's number; each new bucket is a node. A bucket of one conversation is a chain, written row by row.
   A bucket of at most ``LOCAL`` turns is local. Only buckets beyond that are dealt out again, by the next
   turn, so there are as many rounds as the deepest of them has turns.
3. **Multikey quicksort.** Local buckets are packed into tasks and sorted by ternary partitioning on one turn at a time; what
   is equal to the pivot goes one turn deeper, and that step emits a node.

Sums over subtrees are made within a local bucket and added to the nodes above by one aggregation. A common turn, a
conversation with a third of all rows and a large group of copies are met by ``join_counted`` (common keys, of which there
are at most a thousand, are broadcast; the others shuffled), by partial aggregates, and by positions that come from a global sort.
SHA-256 goes byte by byte, so the ids that end at one node are hashed as a stream of pieces by one task, in constant memory.

Results for odd rows: null role or text is the empty string; rows without a conversation's id are left out, as they belong
to none. Turns are ordered by number, null first; rows of the same number by the SHA-256 of role and text, and
repeated rows all count. An empty table gives no nodes, not even a root. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexbrook.operators.lineage import numbered

from .common import checkpointed, release_memory

#: Turns that a local bucket holds at most, and turns of each conversation that a round of radix passes has at hand.
LOCAL, HEAD = 4096, 16
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
EMPTY = hashlib.sha256(b"").hexdigest()


def join_counted(rows: DataFrame, known: DataFrame, key: str, total: int) -> DataFrame:
    """rows joined with known, which has one row a key and as ``n`` how many of the total rows have it. Keys with more than a
    thousandth of all rows, at most a thousand of them, are broadcast; the others meet by a shuffle."""
    many = F.col("n") > total / 1000
    common = known.where(many)
    others = rows.join(F.broadcast(common.select(key)), key, "left_anti").join(known.where(~many), key)
    return rows.join(F.broadcast(common), key).unionByName(others)


def coded(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, turn_id, n_bytes, length): turns as numbers, positions from 1, and how many turns their conversation has."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("number"), digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    rows = checkpointed(rows)
    total = rows.count()
    dictionary = checkpointed(rows.groupBy("digest").agg(F.count("*").alias("n")).withColumn("turn_id", F.monotonically_increasing_id()))
    turns = numbered(join_counted(rows, dictionary, "digest", total).drop("n"), "at", F.col("conv_id"), F.col("number").asc_nulls_first(), F.col("digest"))
    turns = checkpointed(turns.select("conv_id", "at", "turn_id", "n_bytes"))
    starts = turns.groupBy("conv_id").agg(F.min("at").alias("start"), F.count("*").alias("n"))
    return checkpointed(join_counted(turns, starts, "conv_id", total).select("conv_id", (F.col("at") - F.col("start") + 1).alias("position"), "turn_id", "n_bytes", F.col("n").alias("length")))


def rebuilt(turns: DataFrame, family: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first of their family does: (turns, conversations) as ``trie`` takes them.

    With h = crc32(id) mod (most + 1), conversation c has the first h turns of c - c % family, then its own turns after its first h.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    base = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = own.join(base, "base", "left").withColumn("taken", F.least(F.col("h"), F.coalesce("base_n", F.lit(0))))
    convs = checkpointed(convs.select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("length"), "n"))
    first = turns.where(F.col("position") <= most).select(F.col("conv_id").alias("base"), "position", "turn_id", "n_bytes")
    given = first.join(convs, "base").where("position <= h").select("conv_id", F.col("position").alias("depth"), "turn_id", "n_bytes", "length")
    kept = join_counted(turns.drop("length").where(F.col("position") > h), convs, "conv_id", turns.count())
    kept = kept.select("conv_id", (F.col("position") - F.col("h") + F.col("taken")).alias("depth"), "turn_id", "n_bytes", "length")
    return checkpointed(given.unionByName(kept)), convs.select("conv_id", "length")


def plain(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are: (turns, conversations) as ``trie`` takes them."""
    return turns.withColumnRenamed("position", "depth"), turns.groupBy("conv_id").agg(F.max("length").alias("length"))


def ordered_digests(rows: DataFrame, key: list[str], value: str, piece: int = 50_000) -> DataFrame:
    """(key, ends): for each key SHA-256 of its numbers, ascending, joined by commas. Numbers are sorted and joined range by range
    and fed to the hash piece by piece; no task holds a key's whole list."""
    kinds = ", ".join(f"{k} long" for k in key)
    runs = rows.select(*key, value).repartitionByRange(*key, value).sortWithinPartitions(*key, value)

    def join(batches):
        for b in batches:
            keys = list(zip(*(b.column(i).to_pylist() for i in range(len(key))), strict=True))
            values, at = b.column(len(key)).to_pylist(), 0
            out = []
            while at < len(keys):
                end = at + 1
                while end < len(keys) and keys[end] == keys[at] and end - at < piece:
                    end += 1
                out.append((*keys[at], values[at], ",".join(map(str, values[at:end]))))
                at = end
            columns = list(zip(*out, strict=True)) or [[]] * (len(key) + 2)
            yield pa.record_batch([*(pa.array(c, pa.int64()) for c in columns[:-1]), pa.array(columns[-1], pa.string())], names=[*key, "first", "part"])

    def digest(batches):
        now, h = None, None
        for b in batches:
            done = []
            parts = b.column(len(key) + 1).to_pylist()
            for k, part in zip(zip(*(b.column(i).to_pylist() for i in range(len(key))), strict=True), parts, strict=True):
                if k == now:
                    h.update(b",")
                else:
                    if now is not None:
                        done.append((*now, h.hexdigest()))
                    now, h = k, hashlib.sha256()
                h.update(part.encode())
            yield made(done)
        if now is not None:
            yield made([(*now, h.hexdigest())])

    def made(done):
        columns = list(zip(*done, strict=True)) or [[]] * (len(key) + 1)
        return pa.record_batch([*(pa.array(c, pa.int64()) for c in columns[:-1]), pa.array(columns[-1], pa.string())], names=[*key, "ends"])

    parts = runs.mapInArrow(join, f"{kinds}, first long, part string")
    return parts.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(digest, f"{kinds}, ends string")


def quicksorted(bucket: list[tuple], depth: int, parent: int, n_bytes: int) -> list[list]:
    """The nodes of a bucket of conversations (id, turns, their bytes) that share their first ``depth`` turns, top first: rows of
    NODE. Ternary partitioning by one turn at a time; an equal part that has another turn is a node one deeper."""
    nodes, above = [[min(c[0] for c in bucket), depth, parent, len(bucket), 0, 0, (len(bucket) - 1) * n_bytes, EMPTY]], [-1]
    work = [(bucket, 0, 0)]  # conversations, turns that they share below the top, their node
    while work:
        part, d, node = work.pop()
        if len(part) == 1:  # a chain
            conv, turns, sizes = part[0]
            for _ in range(d, len(turns)):
                d += 1
                nodes[node][4] += 1
                nodes.append([conv, depth + d, nodes[node][0], 1, 0, 0, 0, EMPTY])
                above.append(node)
                node = len(nodes) - 1
            nodes[node][7] = hashlib.sha256(str(conv).encode()).hexdigest()
            continue
        pivot = part[len(part) // 2][1]
        pivot = pivot[d] if d < len(pivot) else -1
        less, equal, more = [], [], []
        for c in part:
            digit = c[1][d] if d < len(c[1]) else -1
            (less if digit < pivot else equal if digit == pivot else more).append(c)
        work += [(x, d, node) for x in (less, more) if x and len(x) < len(part)]
        if pivot == -1:
            nodes[node][7] = hashlib.sha256(",".join(map(str, sorted(c[0] for c in equal))).encode()).hexdigest()
            continue
        nodes[node][4] += 1
        nodes.append([min(c[0] for c in equal), depth + d + 1, nodes[node][0], len(equal), 0, 0, (len(equal) - 1) * equal[0][2][d], EMPTY])
        above.append(node)
        work.append((equal, d + 1, len(nodes) - 1))
    for i in range(len(nodes) - 1, -1, -1):
        nodes[i][5] = nodes[i][5] or 1
        if i:
            nodes[above[i]][5] += nodes[i][5]
            nodes[above[i]][6] += nodes[i][6]
    return nodes


def sorted_locally(rows: DataFrame) -> DataFrame:
    """NODE rows and ``top`` (is the bucket's own node) for local buckets: rows (bucket, start, parent, last_bytes, conv_id, depth, turn_id, n_bytes), one with a
    null depth for a conversation that ends with the bucket's own turn."""
    names = ["bucket", "start", "parent", "last_bytes", "conv_id", "depth", "turn_id", "n_bytes"]
    dealt = rows.select(*names).repartition("bucket", "start").sortWithinPartitions("bucket", "start", "conv_id", "depth")
    fields = [f.split()[0] for f in NODE.split(", ")]

    def nodes_of(t: pa.Table) -> pa.RecordBatch:
        """All nodes of whole buckets."""
        c = {n: t.column(n).to_numpy() for n in names[:5]}
        turns, sizes = (t.column(n).fill_null(-1).to_numpy() for n in ("turn_id", "n_bytes"))
        new = lambda *by: np.flatnonzero(np.r_[True, np.any([np.diff(c[k]) != 0 for k in by], axis=0)])
        begins, out, tops = new("bucket", "start", "conv_id"), [], []
        ends = np.r_[begins[1:], len(turns)]
        buckets = np.searchsorted(begins, np.r_[new("bucket", "start"), len(turns)])
        for a, b in zip(buckets, buckets[1:], strict=False):
            held = []
            for x, y in zip(begins[a:b], ends[a:b], strict=True):
                ended = turns[x] < 0
                held.append((int(c["conv_id"][x]), [] if ended else turns[x:y].tolist(), [] if ended else sizes[x:y].tolist()))
            at = begins[a]
            nodes = quicksorted(held, int(c["start"][at]), int(c["parent"][at]), int(c["last_bytes"][at]))
            tops += [True] + [False] * (len(nodes) - 1)
            out += nodes
        columns = list(zip(*out, strict=True))
        return pa.record_batch([*(pa.array(x, pa.int64()) for x in columns[:-1]), pa.array(columns[-1], pa.string()), pa.array(tops, pa.bool_())], names=[*fields, "top"])

    def run(batches):
        held: list[pa.Table] = []
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            bucket, start = (t.column(n).to_numpy() for n in ("bucket", "start"))
            cut = int(np.flatnonzero((bucket != bucket[-1]) | (start != start[-1]))[-1]) + 1 if bucket[0] != bucket[-1] or start[0] != start[-1] else 0
            if held and (held[-1].column("bucket")[-1].as_py() != bucket[0] or held[-1].column("start")[-1].as_py() != start[0]):
                yield nodes_of(pa.concat_tables(held))
                held = []
            if cut:
                yield nodes_of(pa.concat_tables([*held, t.slice(0, cut)]))
                held = []
            held.append(t.slice(cut))
        if held:
            yield nodes_of(pa.concat_tables(held))
        release_memory()

    return dealt.mapInArrow(run, NODE + ", top boolean")


def trie(turns: DataFrame, convs: DataFrame, local: int = LOCAL) -> DataFrame:
    """NODE rows: every distinct sequence of first turns of conversations, the root (no turn) included.

    ``turns``: (conv_id, depth from 1, turn_id, n_bytes, length); ``convs``: (conv_id, length), turnless ones included. A node is
    named by its smallest member and its depth. n_leaves and saved_tokens are sums over its subtree: nodes without children,
    and for each node (n_convs - 1) times its last turn's bytes.
    """
    n_turns = turns.count()
    whole = convs.agg(F.min("conv_id").alias("m"), F.count("*").alias("n")).where("n > 0")
    top = checkpointed(whole.select("m", F.lit(0).cast("long").alias("d"), F.lit(None).cast("long").alias("parent"), "n", F.lit(0).cast("long").alias("last_bytes"), F.array().cast("array<long>").alias("line")))
    first = top.first()
    if first is None:
        return turns.sparkSession.createDataFrame([], NODE)
    tops, locals_, singles, ended = [top], [], [], []
    active = convs.select("conv_id", "length", F.array().cast("array<long>").alias("path"), F.lit(first["m"]).alias("m"), F.array().cast("array<long>").alias("line"))
    n_active, d = first["n"], 0
    while n_active:
        if d % HEAD == 0:  # each conversation's next turns, HEAD of them at most
            head = turns.where(F.col("depth").between(d + 1, d + HEAD)).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("depth", "turn_id", "n_bytes"))).alias("head"))
            active = active.drop("head").join(head, "conv_id", "left")
        ended.append(active.where(F.col("length") == d).select("m", F.lit(d).cast("long").alias("d"), "conv_id"))
        digit = F.element_at("head", d % HEAD + 1)
        moved = active.where(F.col("length") > d).select(
            "conv_id", "length", "head", F.concat("path", F.array(digit["turn_id"])).alias("path"), F.col("m").alias("parent"), F.concat("line", F.array("m")).alias("line"), digit["n_bytes"].alias("size")
        )
        moved = checkpointed(moved)
        d += 1
        found = moved.groupBy("path").agg(F.count("*").alias("n"), F.min("conv_id").alias("m"), F.sum(F.col("length") - d).alias("rest"), F.min("parent").alias("parent"), F.min("size").alias("last_bytes"), F.min("line").alias("line"))
        kind = F.when(F.col("n") == 1, "single").when(F.col("n") + F.col("rest") <= local, "local").otherwise("top")
        found = checkpointed(found.withColumn("kind", kind))
        placed = checkpointed(join_counted(moved.drop("parent", "line"), found, "path", moved.count()).drop("n"))
        locals_.append(placed.where("kind = 'local'").select("conv_id", F.col("m").alias("bucket"), F.lit(d).cast("long").alias("start"), "parent", "last_bytes"))
        singles.append(placed.where("kind = 'single'").select("conv_id", F.lit(d).cast("long").alias("start"), "parent", F.col("length").alias("n")))
        tops.append(found.where("kind = 'top'").select("m", F.lit(d).cast("long").alias("d"), "parent", "n", "last_bytes", "line"))
        active = placed.where("kind = 'top'").select("conv_id", "length", "head", "path", "m", "line")
        n_active = active.count()

    def union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    # local buckets: conversations with all turns below the bucket's own; one of so many turns that it cannot be local is not looked at
    below = turns.where(F.col("length") <= local + d).select(F.col("conv_id").alias("id"), "depth", "turn_id", "n_bytes")
    kept = union(locals_)
    joined = kept.join(below, (F.col("conv_id") == F.col("id")) & (F.col("depth") > F.col("start")), "left").drop("id")
    sorted_ = checkpointed(sorted_locally(joined))
    # chains
    alone = checkpointed(union(singles))
    chain = join_counted(turns.drop("length"), alone, "conv_id", n_turns).where("depth >= start")
    last = F.col("depth") == F.col("n")
    chains = chain.select(
        "conv_id", "depth", F.when(F.col("depth") == F.col("start"), F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(EMPTY)).alias("ends_sha256"),
    )
    # nodes above: what hangs right below each, summed up to all nodes on its line
    tops_ = checkpointed(union(tops))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    below_top = sorted_.where("top").select(F.col("parent_conv_id").alias("m"), (F.col("depth") - 1).alias("d"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    below_top = below_top.unionByName(alone.select(F.col("parent").alias("m"), (F.col("start") - 1).alias("d"), one.alias("leaves"), zero.alias("saved")))
    below_top = below_top.unionByName(tops_.where("d > 0").select(F.col("parent").alias("m"), (F.col("d") - 1).alias("d"), zero.alias("leaves"), zero.alias("saved")))
    direct = below_top.groupBy("m", "d").agg(F.count("*").alias("n_children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    laid = checkpointed(tops_.join(direct, ["m", "d"], "left").withColumn("n_children", F.coalesce("n_children", zero)))
    own = laid.select(
        F.posexplode(F.concat("line", F.array("m"))).alias("at", "of"), F.when(F.col("n_children") == 0, one).otherwise(F.col("leaves")).alias("leaves"),
        (F.coalesce("saved", zero) + (F.col("n") - 1) * F.col("last_bytes")).alias("saved"),
    )
    sums = own.groupBy(F.col("of").alias("m"), F.col("at").cast("long").alias("d")).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    ends = ordered_digests(union(ended), ["m", "d"], "conv_id")
    above = laid.join(sums, ["m", "d"]).join(ends, ["m", "d"], "left").select(
        F.col("m").alias("conv_id"), F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256")
    )
    return above.unionByName(sorted_.drop("top")).unionByName(chains)


def oracle(family: int = 5, most: int = 8) -> str:
    """SQL for the rows of the query: every prefix named by the digests of its turns."""
    step = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return f"""WITH RECURSIVE bits AS (SELECT n, n::BIGINT AS c, 0 AS k FROM range(256) t(n) UNION ALL SELECT n, {step}, k + 1 FROM bits WHERE k < 8),
    steps AS (SELECT list(c ORDER BY n) AS crc FROM bits WHERE k = 8),
    t AS (SELECT conv_id, turn, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS dg, octet_length(encode(coalesce(text, ''))) AS nb FROM conversations WHERE conv_id IS NOT NULL),
    p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, dg) AS pos FROM t),
    c AS (SELECT conv_id, conv_id - conv_id % {family} AS base, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii((conv_id::VARCHAR)[i])::BIGINT)),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) % {most + 1} AS h FROM (SELECT DISTINCT conv_id FROM t), steps),
    r AS (SELECT c.conv_id, 0 AS part, p.pos, dg, nb FROM c JOIN p ON p.conv_id = c.base AND p.pos <= h UNION ALL SELECT c.conv_id, 1, p.pos, dg, nb FROM c JOIN p ON p.conv_id = c.conv_id AND p.pos > h),
    o AS (SELECT conv_id, dg, nb, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth FROM r),
    x AS (SELECT conv_id, depth, nb, string_agg(dg, '' ORDER BY depth) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM o UNION ALL SELECT conv_id, 0, 0, '' FROM c),
    l AS (SELECT conv_id, max(depth) AS deepest FROM x GROUP BY conv_id),
    n AS (SELECT depth, path, min(x.conv_id) AS conv_id, count(*) AS n_convs, max(nb) AS nb, coalesce(string_agg(x.conv_id::VARCHAR, ',' ORDER BY x.conv_id) FILTER (depth = deepest), '') AS ends FROM x JOIN l USING (conv_id) GROUP BY depth, path),
    k AS (SELECT n.*, q.conv_id AS parent_conv_id, (SELECT count(*) FROM n ch WHERE ch.depth = n.depth + 1 AND left(ch.path, length(n.path)) = n.path) AS n_children FROM n LEFT JOIN n q ON q.depth = n.depth - 1 AND q.path = left(n.path, length(n.path) - 64)),
    s AS (SELECT a.depth, a.path, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.nb)::BIGINT AS saved_tokens FROM k a JOIN k b ON b.depth >= a.depth AND left(b.path, length(a.path)) = a.path GROUP BY a.depth, a.path)
    SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256 FROM k JOIN s USING (depth, path)"""
