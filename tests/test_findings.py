"""Tables on which queries once failed: many citations, odd characters, large groups."""

import json
import os
import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from oracle import SF, TABLES, rows_of_df, rows_of_sql
from pyspark.sql import functions as F

from lexbrook.functions import dates, references
from lexbrook.operators import graph, index, lawtrees, repair, resolve, search
from lexbrook.plans import registry

needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture
def tables(tmp_path):
    """A folder with the test tables, but for those given."""

    def put(**own):
        for t in TABLES:
            to = tmp_path / f"{t}.parquet"
            if t in own:
                pq.write_table(own[t], to)
            elif not to.exists():
                to.symlink_to(f"{SF}/{t}.parquet")
        return str(tmp_path)

    return put


def documents(texts, first=0):
    n = len(texts)
    return pa.table({"doc_id": pa.array(range(first, first + n), pa.int64()), "text": texts, "lang": ["de"] * n, "source": ["s"] * n, "n_chars": pa.array([len(x or "") for x in texts], pa.int64())})


def same(spark, name, folder):
    found = rows_of_df(registry.QUERIES[name](spark, folder))
    assert found == rows_of_sql(registry.ORACLES[name], folder)
    return found[1]


def test_a_brief_has_all_citations(spark):
    d = spark.range(1).select(F.lit("a").alias("decision_id"))
    edges = spark.range(250).select(F.format_string("s%d", "id").alias("source_decision_id"), F.lit("A").alias("target_ref"), F.lit("docket").alias("target_type"), F.lit(1).alias("mention_count"))
    targets = edges.select("source_decision_id", "target_ref", F.lit("a").alias("target_decision_id"), F.lit("docket_norm").alias("match_type"), F.lit(0.5).alias("confidence_score"))
    statutes = spark.createDataFrame([("a", "ART.1.OR")], "decision_id string, statute_id string")
    assert len(graph.case_brief(d, edges, targets, statutes, "a").first()["cited_by"]) == 250


@needs_tables
@pytest.mark.parametrize("name", ["volumes_cut", "compilations_cut"])
def test_volumes_keep_odd_white_space_and_lines(spark, tables, name):
    odd = [" ", " ", "\x85", "\x0b", "\r", "\r\n", "　", "éNo. 3", "\n2Sachregisteré", "Nr. 4é", "Nr. 7\n"]
    texts = [f"{odd[i % 11]}{odd[i * 7 % 11]} Nr. {i % 9}\n" + f"{odd[i * 3 % 11]}wort {i}\n5 -\x0b20\n" * 9 + odd[i * 5 % 11] + " " + odd[i % 6] for i in range(400)]
    assert same(spark, name, tables(documents=documents(texts)))


def links_of(spark, n=60):
    """Decisions that share dockets, some without dates, and cite dockets and reports, their own among them."""
    rng = random.Random(5)
    dockets = ["4A_1_2020", "BGE 1 III 2", "1 III 2", "BGE 2 III 3", "3 III 4", "E_5_2019"]
    nodes = [(f"n{i}", rng.choice(["bger", "bge", "zh", ""]), rng.choice(["CH", "ZH", None]), rng.choice(["2020-01-01", "2019-06-01", "2010-03-04", "None", "", None]), rng.choice([*dockets, None])) for i in range(n)]
    edges = [(f"n{rng.randrange(n + 3)}", r, "bge" if r.startswith("BGE") else "docket", rng.randint(1, 3)) for r in [*dockets, "2 III 3", "BGE 3 III 4", "9 IX 9"] for _ in range(20)]
    edges = list({e[:2]: e for e in edges}.values())
    spark_nodes = spark.createDataFrame(nodes, "decision_id string, court string, canton string, decision_date string, docket_norm string")
    return spark.createDataFrame(edges, "source_decision_id string, target_ref string, target_type string, mention_count int"), spark_nodes, nodes, edges


def test_links_are_all_pairs_and_counts_come_without_them(spark):
    edges, nodes, rows, cited = links_of(spark)
    links = graph.Links.of(edges, nodes)
    pairs = links.pairs().collect()
    reports = [r for r in rows if r[1] in graph.REPORT_COURTS]
    brute = set()
    for s, ref, kind, _ in cited:
        own = [(s, ref, r[0], "docket_norm") for r in rows if kind == "docket" and r[4] == ref and r[0] != s]
        own += [(s, ref, r[0], "bge_norm") for r in reports if kind == "bge" and r[4] in (ref, ref[4:]) and r[0] != s]
        if not own and kind == "docket":
            own = [(s, ref, r[0], "bge_bare") for r in reports if r[4] == "BGE " + ref and r[0] != s]
        brute.update(own)
    assert len(pairs) == len(brute) and {tuple(p)[:4] for p in pairs} == brute
    assert any(s == r[0] and ref == r[4] for s, ref, *_ in cited for r in rows)
    # the order of the candidates of a citation, the source left out
    for key in {(p[0], p[1]) for p in pairs if p[3] == "docket_norm"}:
        own = [r for r in rows if r[4] == key[1] and r[0] != key[0]]
        first = max(own, key=lambda r: (r[3] is not None, r[3] or "", [-ord(c) for c in r[0]]))
        assert {p[2]: p[4] for p in pairs if (p[0], p[1]) == key}[first[0]] >= 0.05
    mentions = {e[:2]: e[3] for e in cited}
    by_target = {}
    for p in pairs:
        by_target.setdefault(p[2], []).append(p)
    assert {tuple(r) for r in links.citations().collect()} == {(t, len({p[0] for p in ps})) for t, ps in by_target.items()}
    authority = {r[0]: r[1] for r in graph.authority(links).collect()}
    assert authority == pytest.approx({t: min(1, 0.03 * sum(mentions[p[0], p[1]] * p[4] for p in ps)) for t, ps in by_target.items()})
    stats = graph.graph_stats(edges, links).first()
    assert (stats["links"], stats["resolved"], stats["cited"]) == (len(pairs), len({p[:2] for p in pairs}), len(by_target))
    assert graph.resolution_rate(edges, links).first()["resolved"] == stats["resolved"]
    for one in ("n3", "n7", rows[0][0]):
        assert sorted(map(tuple, links.about(one).collect())) == sorted(tuple(p) for p in pairs if one in (p[0], p[2]))


def test_no_step_shuffles_pairs(spark):
    """Of 400 citations of one docket with 400 decisions, only the sides are shuffled."""
    nodes = spark.range(400).select(F.format_string("n%d", "id").alias("decision_id"), F.lit("bger").alias("court"), F.lit("CH").alias("canton"), F.lit("2020-01-01").alias("decision_date"), F.lit("4A_1_2020").alias("docket_norm"))
    edges = spark.range(400).select(F.format_string("s%d", "id").alias("source_decision_id"), F.lit("4A_1_2020").alias("target_ref"), F.lit("docket").alias("target_type"))
    plan = graph.Links.of(edges, nodes).pairs()
    assert plan.count() == 160_000
    assert plan._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[0].count("Exchange") == 0


def test_many_queries_are_scored_document_by_document(spark, monkeypatch):
    """The same scores in either way."""
    docs = spark.range(40).select(F.format_string("d%d", "id").alias("decision_id"), F.expr("concat_ws(' ', transform(sequence(0, id), x -> concat('w', x % 7)))").alias("full_text"))
    ix = index.Index.of(docs, ["full_text"])
    asked = spark.range(20).select("id", F.explode(F.array(F.lit("w1"), F.concat(F.lit("w"), F.col("id") % 7))).alias("term")).distinct().select(F.col("id").alias("query_id"), "term")
    few = {(r[0], r[1]): r[2] for r in search.bm25_batch(ix, asked, {"full_text": 1.2}).collect()}
    for name, n in (("FEW_ROWS", 0), ("PACK_ROWS", 10), ("TASK_DOCS", 8)):
        monkeypatch.setattr(search, name, n)
    many = search.bm25_batch(ix, asked, {"full_text": 1.2})
    assert {(r[0], r[1]): r[2] for r in many.collect()} == pytest.approx(few)


def test_a_pair_is_out_when_enough_documents_are_before_it(spark, monkeypatch):
    """F1: ranks are those of all scores, with copies and in several rounds; a retrieval check does not score all documents for all queries."""
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["der", "die", "haus", "miete", "zins", "recht", f"w{i % 9}", "é"], k=rng.randint(1, 12))) for i in range(60)]
    docs = spark.createDataFrame([(f"d{i}", texts[i % 45]) for i in range(60)] + [("d99", "")], "decision_id string, full_text string")
    ix = index.Index.of(docs, ["full_text"])
    asked = [(f"d{i}", w) for i in range(60) for w in sorted(set(rng.choices(["haus", "miete", "zins", "é", f"w{i % 9}", "nirgends"], k=3)))]
    queries = spark.createDataFrame(asked, "query_id string, term string")
    pairs = spark.createDataFrame([(f"d{i}", f"d{(i * 7 + j) % 60}") for i in range(60) for j in range(6)] + [("d1", "d99"), ("d1", "gone"), ("none", "d1")], "query_id string, doc string")
    scores = {}
    for q, d, x in search.bm25_batch(ix, queries, {"full_text": 1.2}).collect():
        scores.setdefault(q, []).append((-round(x, 9), d))
    ranks = {(q, d): i + 1 for q, xs in scores.items() for i, (_, d) in enumerate(sorted(xs)) if i < 5}
    want = {tuple(p): ranks[tuple(p)] for p in pairs.collect() if tuple(p) in ranks}
    assert 0 < len(want) < 300
    for name, n in (("BLOCK_DOCS", 8), ("WIDER", 2), ("TASK_PAIRS", 100), ("ROUND_ROWS", 700)):
        monkeypatch.setattr(search, name, n)
    assert {(r[0], r[1]): r[2] for r in search.placed(ix, queries, pairs, {"full_text": 1.2}, 5).collect()} == want
    monkeypatch.setattr(search, "bm25_batch", None)
    notes = spark.createDataFrame([("d3", "d4", texts[4]), ("d3", "d99", texts[4]), ("d5", "d5", texts[5])], "source_id string, target_id string, query string")
    got = resolve.retrieval_check(ix, notes, {"full_text": 1.2}, 10).first()
    assert (got["pairs"], got["hits"]) == (3, 2)


def test_an_index_moves_rows_of_documents_not_words(spark, tmp_path):
    """F17, F18, F19, F21 to F24: what is dealt out are a document's postings of a bucket, counted before; those written are the words of all fields."""
    rows = [("a", "Eins zwei Eins", "zwei drei " * 400), ("b", None, ""), ("c", "Ünique 𝒳y", "ein,zwei; eins"), (None, "eins", "eins"), ("d", "drei", None)]
    df = spark.createDataFrame(rows, "decision_id string, title string, full_text string")
    packed = index._packed(df, ["title", "full_text"], "decision_id")
    assert packed.where("doc = 'a'").count() <= 3 and packed.where("doc = 'b' OR doc IS NULL").count() == 0
    assert packed.select("bucket", F.explode(F.split("terms", " ")).alias("t")).where(F.col("bucket") != index.bucket_of("t")).count() == 0
    words = {("a", "title"): ["eins", "zwei", "eins"], ("a", "full_text"): ["zwei", "drei"] * 400, ("c", "title"): ["unique", "𝒳y"], ("c", "full_text"): ["ein", "zwei", "eins"], ("d", "title"): ["drei"]}
    want = sorted((d, f, t, w.count(t), [i for i, x in enumerate(w) if x == t], len(w), sum(len(v) for (e, _), v in words.items() if e == d)) for (d, f), w in words.items() for t in set(w))
    for again in (False, True):  # an id that is repeated is one document
        given = df.unionByName(df.where("decision_id = 'd'")) if again else df
        made = index.Index.write(given, str(tmp_path / f"index{again}"), ["title", "full_text"])
        got = [tuple(r) for r in made.rows.select("doc", "field", "term", "tf", "positions", "own", "length").collect()]
        if again:
            got = [(*r[:3], 1, [0], *r[5:]) if r[0] == "d" and r[3] == 2 and r[4] == [0, 0] else r for r in got]
        assert sorted(got) == want
        assert made.docs == 4 and made.words == {"title": 6 + again, "full_text": 803}
        assert {r["term"]: r["df"] for r in made.terms.collect()} == {t: len({d for d, _, x, *_ in want if x == t}) for t in {x[2] for x in want}}


def test_a_task_reads_the_files_of_its_own_rows(tmp_path):
    """where rows lie is told once, where spans are cut; no task reads a key from its beginning."""
    import json

    from lexbrook.sources import paged

    want = []
    for page, n in enumerate((0, 49, 333, 51)):
        rows = [{"id": len(want) + i, "value": "x ü " * (i % 90)} for i in range(n)]
        want += [("a", r["id"], r["value"]) for r in rows]
        folder = tmp_path / "key=a" / f"page={page}"
        folder.mkdir(parents=True)
        (folder / "part.json").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows) + "\n" * (page % 2), encoding="utf-8")
    keys, fetch, count = paged.folder_of_pages(str(tmp_path))
    assert keys() == ["a"] and count("a") == len(want)
    for size in (1, 7, 50, 200, 1000):
        found = [r for s in paged.spans("a", 0, len(want), size, 3, fetch.locate) for r in paged.Pages(fetch, size, 1, 0).rows(s)]
        assert found == want and fetch("a", 30, size) == want[30 : 30 + size]
    last = paged.spans("a", 390, 420, 10, 3, fetch.locate)[0]
    for page in range(3):
        (tmp_path / "key=a" / f"page={page}" / "part.json").unlink()
    assert list(paged.Pages(fetch, 10, 1, 0).rows(last)) == want[390:420]


def test_parsers_take_a_batch_in_pieces():
    """what Python holds of a batch at a time is bounded in bytes, not in rows."""
    from lexbrook.functions import markup

    texts = pa.array([None, "", "a" * 300_000, "b" * 2_000_000, "c"] * 9, pa.string())
    held = []

    def parse(some):
        held.append(sum(len(t or "") for t in some))
        return pa.array([t and t[:3] for t in some], pa.string())

    assert markup.in_pieces(texts, parse, pa.string()).to_pylist() == [t and t[:3] for t in texts.to_pylist()]
    assert max(held) <= 2_000_000 + markup.PIECE and len(held) > 8
    assert markup.in_pieces(texts.slice(0, 0), parse, pa.string()).to_pylist() == []


@pytest.mark.parametrize("first", [0, 500])
def test_sparse_search_of_even_weights_is_not_joined_row_by_row(spark, monkeypatch, first):
    """where impact stops nothing early, queries meet vectors in blocks; results are those of the full join."""
    from lexbrook.operators import sparseindex

    rnd = random.Random(4)
    vectors = [(d, {t: rnd.randint(90, 110) / 64 for t in rnd.sample(range(0, 4000, 3), 12)} | {1: 1.5}) for d in range(700)]
    vectors += [(d, vectors[d % 5][1]) for d in range(700, 720)]
    monkeypatch.setattr(sparseindex, "LITTLE", first)
    monkeypatch.setattr(sparseindex, "MEMBERS", 100)
    monkeypatch.setattr(sparseindex, "PACK", 3)
    called = []
    among = sparseindex.SparseIndex._among_all
    monkeypatch.setattr(sparseindex.SparseIndex, "_among_all", lambda *x: called.append(1) or among(*x))
    terms = spark.createDataFrame([(d, t, w) for d, x in vectors for t, w in x.items()], "id long, token_id long, weight double")
    index = sparseindex.SparseIndex.build(terms, 8)
    asked = terms.where("id % 90 = 0").selectExpr("id AS query_id", "token_id", "weight AS w")
    found, used = index.search(asked, 7)
    want = []
    for q, x in vectors:
        if q % 90 == 0:
            scores = sorted((-sum(w * y.get(t, 0) for t, w in x.items()), d) for d, y in vectors)
            want += [(q, d, round(-s, 9), k + 1) for k, (s, d) in enumerate(scores[:7])]
    assert sorted((r["query_id"], r["id"], round(r["score"], 9), r["rank"]) for r in found.collect()) == sorted(want)
    assert (called or first) and used.where("n_read > n_total").count() == 0


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_amendments_are_cut_out_of_a_text_once(spark):
    """The text was searched anew for each field of each reference."""
    texts = ["", "AS 1999 12 BBl 2001 345 x" * 30, "a" * 90 + "\nFF 2010 1" + "b" * 90, "RO 1 2, xAS 1999 1, AS 1999 12x", "z " * 400 + "RU  2003\n4" + " y" * 400]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").repartition(2).select("id", "t", references.amendment_references("t").alias("a"))
    assert plan_of(d).count("regexp_replace(") == 1
    for r in d.collect():
        found = list(re.finditer(references.AMENDMENT, r["t"]))
        assert [(x["kind"], x["year"], x["page"]) for x in r["a"]] == [(m[1], int(m[2]), int(m[3])) for m in found]
        single = [(x, m) for x, m in zip(r["a"], found) if len(m[0]) == len("".join(m.groups())) + 2]
        assert all(x["context"] == r["t"][max(m.start() - 80, 0) : m.end() + 80].replace("\n", " ").strip(" ") for x, m in single)


def test_an_audit_reads_the_date_of_a_text_once(spark):
    """The date was looked for anew for each comparison with the known one."""
    d = spark.createDataFrame([("Urteil vom 5. März 2019 " + "wort " * 20, "2019-03-05")], "full_text string, decision_date string").repartition(2)
    opening = dates.HEADINGS[2][1]
    once = plan_of(d.select(dates.decision_date("full_text"))).count(opening)
    assert 0 < plan_of(repair.date_audit(d)).count(opening) <= once
    assert [tuple(r) for r in repair.date_audit(d).collect()] == [("MATCH", 1)]


def test_texts_of_articles_are_made_once(spark):
    """A condition on them was asked where they are made, so they were made twice."""
    leaf = {"type": "paragraph", "html_content": {"de": "<p>a \t b&#38; &lt;c</p>"}}
    tree = json.dumps({"type": "document", "children": [{"type": "article", "number": {"de": "Art. 1"}, "children": [leaf, {"type": "paragraph"}, leaf]}, {"type": "article", "text": {"de": "Titel"}}]})
    found = lawtrees.articles(lawtrees.nodes(spark.createDataFrame([(1, tree)], "law_id long, tree string")))
    assert [(r["article_num"], r["heading"], r["text"]) for r in found.orderBy("place").collect()] == [("1", "", "a b& <c\na b& <c"), ("", "Titel", "")]
    assert plan_of(found).count("<[^>]+>") == 3  # levels


def test_only_words_of_phrases_bring_their_places(spark):
    """Places of all words that a query names were read and shuffled."""
    d = spark.createDataFrame([("a", "x y z"), ("b", "y x z"), ("c", "z zz y")], "decision_id string, full_text string").repartition(2)
    ix = index.Index.of(d, ["full_text"])
    ix.rows = spark.createDataFrame(ix.rows.collect(), ix.rows.schema).repartition(2)
    run = lambda q: search.run(ix, [("", search.parse(q))], {"full_text": 1.2})
    assert sorted(r["doc"] for r in run('"x y" z* NOT zz').collect()) == ["a"] and sorted(r["doc"] for r in run("y z* NOT x").collect()) == ["c"]
    read = lambda df: [line for line in plan_of(df).split("\n") if "Project" in line][-1]
    assert "positions#" in read(run('"x y"')) and "positions#" not in read(run("x y")).split("null AS positions")[0]
