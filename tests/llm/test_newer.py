"""Resampling, quality and conversation tries against brute force, and on odd rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexbrook.llm import convtrie, quality, queries, resampling
from lexbrook.llm.common import table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, id string, score double, carry string, rank long, weight double, stats string"
LONG = "Einige Wörter, 12 mal 7; " * 20_000
ODD = [
    (1, "the cat is on the mat and the dog is in the house where the old clock of the tower strikes the hour " * 2, "x", 0.5, "c", 7, None, "s"),
    (1, "the cat is on the mat and the dog is in the house where the old clock of the tower strikes the hour " * 2, "x", 0.5, "c", 7, None, "s"),
    (2, None, None, None, None, None, None, None), (None, "A b " * 30, None, None, None, None, None, None), (3, "", None, None, None, None, None, None), (4, LONG, "x", 1.0, "c", 1, 1.0, ""),
    (5, " \n\t ", "en", None, None, None, None, None), (None, None, None, None, None, None, None, None), (6, "🙂 \u0000 é1É", "", None, None, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


# 11 resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_importance(docs, target, n=1, buckets=10_000, percent=10, least=20):
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    runs = lambda w: [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]
    words = [WORD.findall(lower(t)) for _, t in docs]
    grams = [runs(w) for w in words]
    place = lambda g: zlib.crc32(g.encode()) % buckets
    s = collections.Counter(place(g) for gs in grams for g in gs)
    t = collections.Counter(place(g) for x in target for g in runs(WORD.findall(lower(x))))
    n_s, n_t = sum(s.values()), sum(t.values())
    out = []
    for (i, _), w, gs in zip(docs, words, grams, strict=True):
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in map(place, gs))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(w), len(gs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: len(able) * percent // 100]):
        r[5] = k + 1
    return sorted(map(str, out))


@pytest.mark.parametrize("n, percent", [(1, 10), (3, 60)])
def test_importance_equals_brute_force(spark, odd, n, percent):
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()], "doc_id long, text string").union(odd.select("doc_id", "text"))
    target = table(spark, SF, "benchmark")
    want = brute_importance([tuple(r) for r in docs.collect()], [r["text"] for r in target.collect()], n, percent=percent)
    for block_bytes in (1 << 14, 8 << 20):  # many blocks, and few
        got = resampling.importance(docs, target, n=n, percent=percent, block_bytes=block_bytes).collect()
        assert sorted(str([r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"], r["rank"]]) for r in got) == want


def test_words_end_with_their_text():
    import pyarrow as pa

    words, row = resampling.words_of(pa.array(["one", "two THREE", None, "", "-", "é4 a", "b"]))
    assert words.to_pylist() == ["one", "two", "three", "é4", "a", "b"] and row.tolist() == [0, 1, 1, 5, 5, 6]
    assert resampling.words_of(pa.array(["a b", "c", "d e"]).slice(1))[0].to_pylist() == ["c", "d", "e"]
    assert len(resampling.words_of(pa.array([None, ""]))[0]) == 0


def test_importance_of_odd_and_empty_tables(spark, odd):
    target = spark.createDataFrame([(1, "the old clock"), (2, None)], "item_id long, text string")
    got = resampling.importance(odd, target, percent=100, carry=["id", "score", "carry", "rank"]).collect()
    assert len(got) == len(ODD) and sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4]
    one, other = (r for r in got if r["doc_id"] == 1)
    assert one["weight"] == other["weight"] > 0 and abs(one["rank"] - other["rank"]) == 1 and one["carry"]["carry"] == "c"
    assert {r["weight"] for r in got if r["n_features"] == 0} == {0}
    assert resampling.importance(odd.limit(0), target).count() == 0
    assert resampling.importance(odd, target.limit(0)).where("rank IS NOT NULL").count() == 0  # a tenth of four


# 12 quality


def plain_walk(model, x):
    z = model["base"]
    for feature, threshold, value in zip(model["feature"], model["threshold"], model["value"], strict=True):
        node = 0
        for _ in range(model["depth"]):
            node = 2 * node + (2 if x[feature[node]] > threshold[node] else 1)
        z += value[node - len(feature)]
    return 1 / (1 + math.exp(-z))


def test_flat_trees_equal_a_plain_walk():
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(400, 5)), 2)
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    model = quality.grow(x, y, np.ones(len(y)), trees=40, depth=3)
    got = quality.probabilities(model, x)
    assert np.allclose(got, [plain_walk(model, r) for r in x]) and ((got > 0.5) == y).mean() > 0.97
    flat = quality.grow(x, np.ones(len(y)), np.ones(len(y)))
    assert len(flat["feature"]) == 0 and quality.probabilities(flat, x).min() > 0.99
    assert quality.probabilities(quality.grow(np.zeros((0, 5)), np.zeros(0), np.zeros(0)), x)[0] == 0.5


def test_first_split_is_the_best_of_all():
    """A stump on one statistic cuts where a search over all cuts finds the most gain."""
    rng = np.random.default_rng(5)
    x = rng.permutation(60).astype(float)[:, None]
    y = (x[:, 0] >= 41).astype(float)
    y[x[:, 0] == 3] = 1.0
    model = quality.grow(x, y, np.ones(60), trees=1, depth=1, least=0.0)
    p = y.mean()
    g, h = p - y, np.full(60, p * (1 - p))
    gain = {c: sum((g[m].sum() ** 2) / (h[m].sum() + 1) for m in (x[:, 0] <= c, x[:, 0] > c)) for c in x[:, 0]}
    assert model["threshold"][0][0] == max(gain, key=gain.get) == 40


def test_statistics_are_finite_and_tell():
    names = quality.STATISTICS
    for text in ("", " \n", "a", "é" * 3, LONG, "🙂\ud800", "\x00"):
        assert len(quality.statistics(text)) == len(names) and np.isfinite(quality.statistics(text)).all()
    of = lambda t: dict(zip(names, quality.statistics(t), strict=True))
    assert of("BUY NOW!! BUY NOW!!")["upper"] == 1.0 and of("BUY NOW!! BUY NOW!!")["top_word"] == 0.5
    assert of("same line\nsame line\nother")["repeated_lines"] > 0.3 and of("x x x x")["neighbours_equal"] == 0.75


def test_quality_of_held_out_documents(spark):
    got = queries.op12_quality(spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 50 and sum(r["predicted"] == r["quality"] for r in held) / len(held) >= 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


def test_quality_of_odd_and_empty_tables(spark, odd):
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (3, None)], "doc_id long, quality int")
    model = quality.train(odd, labels)
    got = quality.score(odd, model, carry=["score", "stats", "carry"]).collect()
    assert len(got) == len(ODD) and len({r["score"] for r in got if r["doc_id"] == 1}) == 1
    assert len({r["score"] for r in got if not (r["text"] or "")}) == 1 and {r["carry"]["carry"] for r in got if r["doc_id"] == 4} == {"c"}
    assert quality.score(odd.limit(0), model).count() == 0
    assert {r["score"] for r in quality.score(odd, quality.train(odd, labels.limit(0))).collect()} == {0.5}


# 13 conversations


def brute_trie(rows, rebuild=True):
    turns = collections.defaultdict(list)
    key = lambda r: (r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).digest())
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        turns[r[0]].append((r[2] or "", r[3] or ""))
    seqs = dict(turns)
    if rebuild:
        for c in turns:
            h = zlib.crc32(str(c).encode()) % 9
            seqs[c] = turns.get(c - c % 5, [])[:h] + turns[c][h:]
    members = collections.defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(p)).encode()).hexdigest())
        for p, m in members.items()
    )


def rows_of(df):
    return sorted(tuple(r[c.split()[0]] for c in convtrie.NODE.split(", ")) for r in df.collect())


TALK = "conv_id long, turn long, role string, text string, n long, depth long, digest string, at long"


def talks(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], TALK)


def crowd():
    """One first turn in most conversations, a large group of copies, one very long conversation."""
    rows = [(c, t, "user" if t % 2 else "system", f"turn {t}" if t < 2 or c % 3 else f"own {c % 7} {t}") for c in range(120) for t in range(1, 2 + c % 6)]
    return rows + [(1000, t, "user", f"long {t}") for t in range(60)] + [(1001, t, "user", f"long {t}") for t in range(9)]


@pytest.mark.parametrize("local", [4096, 20, 1])
def test_trie_equals_brute_force(spark, local):
    rows = crowd()
    assert rows_of(convtrie.trie(*convtrie.rebuilt(convtrie.coded(talks(spark, rows))), local=local)) == brute_trie(rows)


def test_trie_of_conversations_as_they_are(spark):
    rows = [(7, 1, "user", "a"), (7, 2, "bot", "é"), (9, 1, "user", "a"), (8, 1, "user", "a"), (8, 2, "bot", "é"), (3, 1, "bot", "a")]
    assert rows_of(convtrie.trie(*convtrie.plain(convtrie.coded(talks(spark, rows))))) == brute_trie(rows, rebuild=False)


def test_trie_of_odd_and_empty_tables(spark):
    rows = [(5, None, None, None), (5, 1, "user", None), (5, 1, "user", ""), (None, 1, "user", "x"), (6, 2, "", "long " * 100_000), (6, 2, "", "long " * 100_000), (3, 1, None, "é"), (0, None, "user", "x"), (2**40, 1, "user", "x")]
    assert rows_of(convtrie.trie(*convtrie.rebuilt(convtrie.coded(talks(spark, rows))))) == brute_trie(rows)
    assert rows_of(convtrie.trie(*convtrie.rebuilt(convtrie.coded(talks(spark, rows[:6]))))) == brute_trie(rows[:6])
    assert convtrie.trie(*convtrie.rebuilt(convtrie.coded(spark.createDataFrame([], TALK)))).count() == 0


def test_ids_of_a_node_are_hashed_in_pieces(spark):
    rows = spark.range(10_000).select((F.col("id") % 2).alias("m"), F.lit(1).cast("long").alias("d"), (F.col("id") * 7 % 10_007).alias("c"))
    got = {r["m"]: r["ends"] for r in convtrie.ordered_digests(rows, ["m", "d"], "c", piece=13).collect()}
    for m in (0, 1):
        assert got[m] == hashlib.sha256(",".join(map(str, sorted(i * 7 % 10_007 for i in range(m, 10_000, 2)))).encode()).hexdigest()


@pytest.mark.parametrize("name", ["op11_resampling", "op13_convtrie"])
def test_new_queries_match_their_sql(spark, name):
    from oracle import rows_of_df, rows_of_sql

    assert rows_of_df(queries.QUERIES[name](spark, SF)) == rows_of_sql(queries.ORACLES[name])
    assert isinstance(queries.QUERIES[name](spark, SF).schema, T.StructType)


# near copies, decontamination, pages and toxicity: cases beside those of test_llm


def shingle_sets(texts):
    return [{tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set() for w in ((t or "").lower().split() for t in texts)]


def test_every_shape_of_the_index_finds_nearly_all_links(spark):
    """The three shapes stand for some 10^7, 10^8 and more texts; none links wrongly, and all but one link in ten are found."""
    from lexbrook.llm import simhash

    assert [simhash.shape(n, 0.8)[1] for n in (10**6, 10**8, 10**9, 10**10, 10**14)] == [5, 4, 3, 3, 3] and simhash.shape(10**14, 0.8)[0] <= 15
    rng = np.random.default_rng(6)
    words, docs = [f"w{i}" for i in range(4000)], []
    for k in range(70):
        base = rng.choice(words, 80 + 3 * k).tolist()
        other = list(base)
        for at in rng.choice(len(base), 1 + k % 4, replace=False):
            other[at] = f"x{k}{at}"
        docs += [" ".join(base), " ".join(other)]
    sets = shingle_sets(docs)
    want = {k for k in range(70) if len(sets[2 * k] & sets[2 * k + 1]) >= 0.8 * len(sets[2 * k] | sets[2 * k + 1])}
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    for cut in ((3, 5), (6, 4), (15, 3)):
        group = {r["doc_id"]: r["group"] for r in simhash.near_copies(df, cut=cut).collect()}
        got = {k for k in range(70) if group[2 * k] == group[2 * k + 1]}
        assert got <= want and len(got) >= 0.9 * len(want) and len(set(group.values())) == 140 - len(got), cut


@pytest.mark.parametrize("seed", range(4))
def test_joined_sets_are_those_of_all_pairs(seed):
    """Links of a block connect just what pairs of a Jaccard of the least or more do."""
    import pyarrow as pa

    from lexbrook.llm import simhash

    rng = np.random.default_rng(seed)
    base = rng.choice(10_000, 120, replace=False)
    sets = [set(base.tolist()) for _ in range(30)]
    for k, s in enumerate(sets):  # a chain of edits and some that lie just about the least
        for at in rng.choice(120, k if seed % 2 else 8, replace=False):
            s.discard(int(base[at]))
            s.add(int(20_000 + at + 1000 * k))
    sets += [set(range(30_000 + 7 * k, 30_000 + 7 * k + 3 + k)) for k in range(20)] + [set(base.tolist()[:5])]
    rng.shuffle(sets)
    t = pa.table({"key": pa.array(range(len(sets)), pa.int64()), "shingles": pa.array([sorted(s) for s in sets], pa.list_(pa.int64()))})

    def groups(links):
        root = list(range(len(sets)))
        for _ in sets:
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        return root

    want = [(a, b) for a in range(len(sets)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    got = [(r["a"], r["b"]) for r in simhash.joined(t, 0.8).to_pylist()]
    assert groups(got) == groups(want) and len(got) < len(sets)


def test_items_with_repeated_and_null_ids(spark):
    """Operator, query's SQL and a walk over all windows agree: an id is listed once, a null id never, all items hit."""
    import duckdb

    from lexbrook.llm import decontaminate

    t = "one two three four five six seven eight nine ten eleven"
    items = [(7, t), (7, t), (8, t + " x"), (None, t), (9, "short yes"), (None, "only null"), (10, None), (7, "short yes"), (7, "nowhere at all")]
    docs = [(1, "a " + t + " b"), (1, "a " + t + " b"), (2, "only null here"), (3, None), (None, "short yes"), (4, "zwei " + t), (4, "nothing"), (5, "")]
    found = decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = sorted(str((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"])) for r in found.collect())
    want = []
    for i, text in docs:
        w, hit, ids = (text or "").split(), set(), set()
        for item, x in items:
            v = (x or "").split()
            n = min(10, len(v))
            for at in range(len(w) - n + 1) if n else []:
                if any(w[at : at + n] == v[j : j + n] for j in range(len(v) - n + 1)):
                    hit |= set(range(at, at + n))
                    ids |= {str(item)} if item is not None else set()
        want.append(str((i, len(w), len(hit), sorted(ids), bool(hit))))
    assert got == sorted(want)
    c = duckdb.connect()
    c.execute("create table benchmark(item_id bigint, text varchar)")
    c.execute("create table documents(doc_id bigint, text varchar)")
    c.executemany("insert into benchmark values (?, ?)", items)
    c.executemany("insert into documents values (?, ?)", docs)
    sql = sorted(str(r) for r in c.execute(decontaminate.oracle()).fetchall())
    assert sql == sorted(str((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r["contaminated"])) for r in found.collect())


def test_a_passage_that_all_items_share_makes_rows_not_one_row(spark):
    from lexbrook.llm import decontaminate

    shared = "the very same ten words stand in every single item"
    items = spark.createDataFrame([(i, f"{shared} {i} and more words that follow it here") for i in range(400)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"start {shared} end"), (2, f"{shared} 5 and more"), (3, "the very same ten words stand apart")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.decontaminate(docs, items).collect()}
    assert (got[1]["n_hit"], len(got[1]["items"])) == (10, 400) and got[2]["n_hit"] == 13 and len(got[2]["items"]) == 400 and not got[3]["contaminated"]


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><p><a href=x>one linked sentence</a></p></article>", "one linked sentence"),
        ("<article><p>The first paragraph of the page is long enough, really.</p><p class='market share'>Our market share grew.</p><p class='ad big'>Buy now.</p><p class='share'>Share this.</p></article>", "The first paragraph of the page is long enough, really.\nOur market share grew."),
        ("<body><div><p>A long text, with commas, many of them, that goes on and on and on and on, for a while, to win.</p><p>And another one, as long, or longer still.</p></div><ul><li>one</li><li>two</li></ul><div><p>Short closing note</p></div><ul><li><a>Home</a></li><li><a>About</a></li></ul></body>",
         "A long text, with commas, many of them, that goes on and on and on and on, for a while, to win.\nAnd another one, as long, or longer still.\none\ntwo\nShort closing note"),
        ("<article><p>Long enough text, with commas, to be the article.</p><fieldset><legend>Note</legend><p>Prose in a set.</p></fieldset><fieldset>Name <input type=text></fieldset></article>", "Long enough text, with commas, to be the article.\nNote\nProse in a set."),
        ("<ul><li><a>Home</a></li><li><a>About</a></li></ul>", ""),
    ],
)
def test_pages_keep_what_they_may_not_drop(page, text):
    from lexbrook.llm import html

    assert html.main_text(page) == text


def test_viterbi_is_the_best_of_all_paths():
    """Every way through a short span's lattice, scored letter by letter."""
    import itertools

    from lexbrook.llm import toxicity

    lm = toxicity.CharacterModel({w: 5.0 + len(w) for w in "idiot scum trash loser clown the house and of seat rim".split()})

    def score(path):
        total, at = sum(c for _, c in path), " " * (toxicity.ORDER - 1)
        for ch in "".join(x for x, _ in path) + " ":
            total += lm.log(at, ch)
            at = (at + ch)[1 - toxicity.ORDER :]
        return total

    for span, apart in (("1d10t", False), ("5cum", False), ("tr4$h", False), ("l.o.s", True), ("c l 0", True), ("r1m", False), ("hoouse", False), ("s--e", True), ("0", False), ("7h3", False)):
        columns = toxicity.lattice(span, apart)
        best = max(score(p) for p in itertools.product(*columns))
        read = toxicity.viterbi(lm, columns)
        reached = max(score(p) for p in itertools.product(*columns) if "".join(x for x, _ in p) == read)
        assert reached == pytest.approx(best), span
