"""State with lifetimes, byte tails and the vector index: restarts, grown and rewritten files, exact and crowded searches."""

import collections
import datetime
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexbrook.operators import vectorindex, vectors
from lexbrook.sources import tail
from lexbrook.streaming import state

DAY = datetime.timedelta(days=1)
START = datetime.datetime(2024, 1, 1)


def told(events, ttl=7 * DAY):
    """Brute force over (key, event, ts, kind)."""
    done, gap, tries, out = {}, {}, collections.Counter(), {}
    for k, e, ts, kind in sorted(events, key=lambda x: (x[2], x[1])):
        if k in gap and ts - gap[k] >= ttl:
            del gap[k]
        known = k in done or k in gap
        tries[k] += kind != "asked"
        if kind == "done":
            done.setdefault(k, ts)
        elif kind == "gap" and not known:
            gap[k] = ts
        out[e] = (k, kind, known, tries[k])
    return out


def test_lifetimes_hold_over_a_restart(spark, tmp_path):
    rng = np.random.default_rng(1)
    kinds = ["asked", "asked", "gap", "done"]
    events = [(int(rng.integers(25)), e, START + DAY * (e / 20), kinds[int(rng.integers(4)) if e % 7 == 0 else int(rng.integers(3))]) for e in range(900)]
    events += [(99, 1000 + d, START + d * DAY, "gap") for d in (0, 3, 6, 7, 8, 14, 20, 22)]  # marks at 0, 7, 14, 22
    schema = "key long, event long, ts timestamp, kind string"
    src, to, progress = (str(tmp_path / x) for x in ("src", "to", "progress"))
    for low, high in ((0, 12), (12, 25), (25, 99)):  # three runs; state and watermark live on in the checkpoint
        part = [x for x in events if START + low * DAY <= x[2] < START + high * DAY]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        found = state.with_lifetimes(spark.readStream.schema(schema).parquet(src))
        state.run_to_folder(found, to, progress).awaitTermination()
    got = {r["event"]: (r["key"], r["kind"], r["known"], r["attempts"]) for r in spark.read.parquet(to).collect()}
    assert got == told(events)
    assert [got[1000 + d][2] for d in (0, 3, 6, 7, 8, 14, 20, 22)] == [False, True, True, False, True, False, True, False]
    asked = state.to_fetch(spark.read.parquet(to)).count()
    assert asked == sum(k == "asked" and not known for _, k, known, _ in told(events).values()) > 0


def test_state_store_is_put_back(spark):
    before = spark.conf.get(state.STORE, None)
    with state.rocksdb(spark):
        assert spark.conf.get(state.STORE) == state.ROCKSDB
    assert spark.conf.get(state.STORE, None) == before


def run_tail(spark, folder, **how):
    to, progress = f"{folder}-to", f"{folder}-progress"
    state.run_to_folder(tail.tail(spark, str(folder), **how), to, progress).awaitTermination()
    return [(os.path.basename(r["file"]), r["position"], r["value"]) for r in spark.read.schema(tail.SCHEMA).parquet(to).collect()]


def test_tail_follows_files(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    a, b = folder / "a.jsonl", folder / "b.jsonl"
    a.write_bytes(b'{"n": 1}\n{"n": 2}\n{"n"')
    b.write_bytes("zürich\n\n  x \n".encode())
    (folder / "other.txt").write_text("no\n")
    first = {("a.jsonl", 0, '{"n": 1}'), ("a.jsonl", 9, '{"n": 2}'), ("b.jsonl", 0, "zürich"), ("b.jsonl", 9, "x")}
    assert set(run_tail(spark, folder)) == first
    assert len(run_tail(spark, folder)) == 4  # nothing new
    with a.open("ab") as f:
        f.write(b": 3}\n\xff\n")
    more = first | {("a.jsonl", 18, '{"n": 3}'), ("a.jsonl", 27, "�")}
    got = run_tail(spark, folder)
    assert set(got) == more and len(got) == 6  # the unfinished line came once, whole
    a.write_bytes(b"new\n")  # smaller: read anew
    b.write_bytes(b"same length!!\n"[-b.stat().st_size :])  # of the same size: not looked at
    (folder / "c.jsonl").write_bytes(b"c\n")
    got = run_tail(spark, folder)
    assert set(got) == more | {("a.jsonl", 0, "new"), ("c.jsonl", 0, "c")} and len(got) == 8


def test_tail_reads_unfinished_lines_if_told(spark, tmp_path):
    folder = tmp_path / "open"
    folder.mkdir()
    a = folder / "a.jsonl"
    a.write_bytes(b"one\ntw")
    assert [x[2] for x in run_tail(spark, folder, unfinished="read")] == ["one", "tw"]
    with a.open("ab") as f:
        f.write(b"o\nthree\n")
    assert sorted(x[2] for x in run_tail(spark, folder, unfinished="read")) == ["one", "three", "tw"]
    with a.open("ab") as f:
        f.write(b"four\n")  # from a line's end on nothing is left out
    assert sorted(x[2] for x in run_tail(spark, folder, unfinished="read")) == ["four", "one", "three", "tw"]


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_ranges_cut_no_line(spark, tmp_path, size):
    rng = np.random.default_rng(2)
    lines = [json.dumps({"n": i, "t": "ü" * int(rng.integers(40))}) for i in range(60)]
    (tmp_path / "x.jsonl").write_text("\n".join(lines) + "\n")
    reader = tail.TailReader({"path": str(tmp_path), "rangeBytes": str(size)})
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    got = [v for p in parts for b in reader.read(p) for v in b.column("value").to_pylist()]
    assert got == lines and (size > 64 or len(parts) > 40)


# vectors


def brute(x, ids, q, k):
    s = (q / max(np.linalg.norm(q), 1e-300)) @ vectorindex.unit(x).T
    return [i for _, i in sorted((-round(v, 9), i) for v, i in zip(s, ids, strict=True))[:k]]


@pytest.fixture(scope="module")
def crowd(spark):
    """Clusters, one of which holds a third of all vectors, copies, and vectors of length 0."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    x = np.concatenate([centres[i % 12 if i % 3 else 0] + 0.2 * rng.normal(size=16) for i in range(3000)]).reshape(3000, 16).round(3)
    x[100:140] = x[100]
    x[7] = x[8] = 0
    rows = [(i, v.tolist(), i % 4) for i, v in enumerate(x)] + [(5000, None, 1)]
    return x, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_exact_search_equals_brute_force(spark, crowd, tmp_path):
    x, df = crowd
    ids = [0, 7, 100, 333, 2999]
    q = spark.createDataFrame([(i, x[i].tolist()) for i in ids], "query_id long, query array<float>")
    index = vectorindex.VectorIndex.write(df, str(tmp_path / "index"), cells=30)
    x32 = x.astype(np.float32).astype(float)
    want = {i: brute(x32, range(3000), x32[i], 8) for i in ids}
    for how in ({"probes": 1}, {"probes": 30}):
        got = collections.defaultdict(list)
        for r in index.search(q, 8, exact=True, **how).orderBy("rank").collect():
            got[r["query_id"]].append(r["id"])
        assert dict(got) == want
    plain = collections.defaultdict(list)
    for r in vectors.nearest(df, q, 8).orderBy("rank").collect():
        plain[r["query_id"]].append(r["id"])
    assert dict(plain) == want


def test_exact_search_reads_few_cells_of_clustered_vectors(spark, crowd):
    """The bound keeps most cells away where vectors lie in clusters."""
    x, df = crowd
    index = vectorindex.VectorIndex.build(df, cells=12)
    asked = []
    met = index._meet
    index._meet = lambda rows, k: asked.append(rows.count()) or met(rows, k)
    q = df.where("vec_id % 50 = 3").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    index.search(q, 5, probes=2, exact=True).collect()
    assert asked[0] == 2 * q.count() and asked[1] < 0.5 * 11 * q.count()


def test_recall_of_as_many_probes_as_a_sample_asks_for(spark, crowd):
    x, df = crowd
    index = vectorindex.VectorIndex.build(df)
    assert index.cells.count() > 40 and index.cells.agg(F.sum("n")).first()[0] == 3000
    probes = index.probes_for(10)
    q = df.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    r = vectorindex.recall(index.search(q, 10, probes=probes), index.search(q, 10, exact=True)).first()
    assert probes < 40 and r["n_queries"] == 60 and r["recall"] >= 0.9


def test_search_within_a_scope_and_of_nothing(spark, crowd):
    x, df = crowd
    index = vectorindex.VectorIndex.build(df, scope="label", cells=10)
    q = spark.createDataFrame([(1, x[1].tolist(), 1), (2, x[2].tolist(), 9), (3, None, 1)], "query_id long, query array<float>, label int")
    got = index.search(q, 5, exact=True, scope="label").collect()
    assert {r["query_id"] for r in got} == {1} and all(r["id"] % 4 == 1 for r in got) and len(got) == 5
    nothing = vectorindex.VectorIndex.build(df.limit(0))
    assert nothing.search(q.drop("label"), 5).count() == 0 and index.search(q.limit(0), 5, scope="label").count() == 0
