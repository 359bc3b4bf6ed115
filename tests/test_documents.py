"""Nested laws, volumes, compilations and paged services: shapes, odd rows, restarts, failures; sparse search and compounds."""

import collections
import json
import random

import pytest
from pyspark.sql import functions as F

from lexbrook.operators import compounds, lawtrees, search, sparseindex, volumes
from lexbrook.operators.index import Index
from lexbrook.sources import paged
from lexbrook.streaming import state


def law(*children):
    return {"type": "document", "children": list(children)}


def test_law_trees(spark):
    tree = law(
        {"type": "title", "number": {"de": "I."}, "text": {"de": "Allgemeines"}, "children": [
            {"type": "article", "number": {"de": "§&nbsp;1"}, "text": {"de": "Zweck"}, "children": [
                {"type": "paragraph", "html_content": {"de": "<span class='number'>1</span><span class='text_content'>Dieses  Gesetz<br/>gilt &amp; wirkt&#58;</span>"}, "children": [
                    {"type": "enumeration", "html_content": {"de": "<p>a. hier</p>"}, "children": [{"type": "enumeration", "html_content": {"de": "aa. tiefer"}}]}, {"type": "footnote", "html_content": {"de": "nie"}, "children": [{"type": "paragraph", "html_content": {"de": "auch nie"}}]}]},
                {"type": "image", "html_content": {"de": "Bild"}, "children": [{"type": "paragraph", "html_content": {"de": "nicht geöffnet"}}]}]},
            {"type": "article", "number": {"de": "Art. 5a"}, "children": []}]},
        {"type": "title", "html_content": {"de": "<b>Schluss</b>"}, "children": [{"type": "article", "number": {"de": "2"}, "text": {"de": "Ende"}}]},
    )
    rows = [(1, json.dumps(tree)), (2, "{}"), (3, "no json"), (4, None), (None, json.dumps(tree)), (5, json.dumps(law()))]
    found = lawtrees.nodes(spark.createDataFrame(rows, "law_id long, tree string"))
    got = [(r["law_id"], r["article_num"], r["heading"], r["under"], r["text"]) for r in lawtrees.articles(found).orderBy("law_id", "place").collect()]
    assert got == [(1, "1", "Zweck", "I. Allgemeines", "1 Dieses Gesetz\ngilt & wirkt:\na. hier\naa. tiefer\nBild"), (1, "2", "Ende", "Schluss", "")]
    whole = {r["law_id"]: r["full_text"] for r in lawtrees.whole_texts(found).collect()}
    assert whole == {1: "I. Allgemeines\n\nArt. 1 Zweck\n\n1 Dieses Gesetz\ngilt & wirkt:\na. hier\naa. tiefer\nBild\n\nSchluss\n\nArt. 2 Ende"}
    nothing = lawtrees.nodes(spark.createDataFrame([], "law_id long, tree string"))
    assert nothing.count() == 0 and lawtrees.articles(nothing).count() == 0
    deep = {"type": "article", "number": {"de": "1"}, "children": []}
    at = deep
    for k in range(30):
        at["children"] = [{"type": "paragraph", "html_content": {"de": f"p{k}"}, "children": []}]
        at = at["children"][0]
    one = lawtrees.articles(lawtrees.nodes(spark.createDataFrame([(1, json.dumps(law(deep)))], "law_id long, tree string"))).first()
    assert one["text"].split("\n") == [f"p{k}" for k in range(30)]


def numbered_one_by_one(pages):
    """The rule as a walk over one volume's (number named, back matter)."""
    now, started, pending, out = None, False, None, []
    for k, (nr, back) in enumerate(pages):
        if back and started:
            return out + [None] * (len(pages) - k)
        if not started:
            started = nr == 1 or nr is not None and nr == pending
            now, pending = (nr, None) if started else (None, nr)
        elif nr is not None and nr > now:
            now = nr
        out.append(now)
    return out


@pytest.mark.parametrize("chunk", [3, 1000])
def test_pages_of_volumes(spark, monkeypatch, chunk):
    monkeypatch.setattr(volumes, "CHUNK", chunk)
    rnd = random.Random(chunk)
    rows, want = [], {}
    for v in range(12):
        pages = []
        for p in range(40):
            nr = rnd.choice([None, None, 1 if p > 4 else 7, p // 4, p // 4, p // 4, 2, 199])
            back = p > 30 and rnd.random() < 0.1 or rnd.random() < 0.02
            pages.append((nr if nr else None, back))
            rows.append((v, p * 3, ("" if not nr else f"MKGE Nr. {nr}\n") + ("Sachregister\n" if back else "") + "text"))
        want[v] = numbered_one_by_one(pages)
    rows += [(None, 1, "Nr. 1"), (99, None, "Nr. 1"), (98, 1, None)]
    got = collections.defaultdict(list)
    for r in volumes.page_numbers(spark.createDataFrame(rows, "volume long, page long, text string")).orderBy("volume", "page").collect():
        got[r["volume"]].append(r["number"])
    assert got.pop(98) == [None] and dict(got) == want


def test_header_numbers(spark):
    texts = ["No. l\nText", "Nr 12\n" + "x\n" * 20 + "Nr. 12\nNr. 3", "Nr. 4 und Nr. 3", "x\n" * 6 + "Nr. 9\n" + "y\n" * 7, "Nr. 201", "Nr. 0", None, "", "No. lO"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert [r["n"] for r in df.orderBy("i").select(volumes.header_number("t").alias("n")).collect()] == [1, 12, 3, None, None, None, None, None, 10]


def test_compilations(spark):
    body = "Text der Entscheidung. " * 12
    toc = "1.\nErster Fall ......... 3\n2.\nZweiter Fall....... 5\n"
    pages = [toc, "Vorwort", "3 - 90\n" + body, "4 - 90\nGeschäftsbericht 2020 der Gerichte – Urteile\n" + body, "5 - 90\n" + body, "6 - 90\nkurz"]
    rows = [("a", i, t) for i, t in enumerate(pages)] + [("b", 0, "1.\nEin Titel ohne Verzeichnis\n" + body), ("b", 1, "2.\nNoch ein langer Titel\n" + body), ("c", 0, None), (None, 0, toc)]
    got = {(r["compilation"], r["number"]): (r["title"], r["text"]) for r in volumes.decisions_of_compilations(spark.createDataFrame(rows, "compilation string, page long, text string")).collect()}
    assert set(got) == {("a", 1), ("a", 2), ("b", 1), ("b", 2)}
    assert got["a", 1][0] == "Erster Fall" and got["a", 1][1].count("Text der") == 24 and "Geschäftsbericht" not in got["a", 1][1]
    assert got["a", 2][0] == "Zweiter Fall" and got["a", 2][1].endswith("kurz") and got["b", 2][0] == "Noch ein langer Titel"


# services


def service(failures, folder):
    """A service of two keys whose pages fail at first, as told by files that stand for calls."""

    def fetch(key, offset, size):
        import os

        mark = f"{folder}/{key}-{offset}"
        calls = len([f for f in os.listdir(folder) if f.startswith(f"{key}-{offset}.")])
        open(f"{mark}.{calls}", "w").close()
        if calls < failures.get((key, offset), 0):
            raise OSError("busy")
        total = int(open(f"{folder}/n_{key}").read())
        return [(key, i) for i in range(offset, min(offset + size, total))]

    def count(key):
        return int(open(f"{folder}/n_{key}").read())

    return fetch, count


def test_failed_pages_are_asked_for_again(spark, tmp_path):
    for k, n in (("a", 95), ("b", 7)):
        (tmp_path / f"n_{k}").write_text(str(n))
    fetch, count = service({("a", 20): 2, ("b", 0): 1}, str(tmp_path))
    source = paged.paged(fetch, ["a", "b"], "key string, id long", count, size=10, pages=3, wait=0.01)
    df = paged.load(spark, source)
    got = [tuple(r) for r in df.collect()]
    assert sorted(got) == [("a", i) for i in range(95)] + [("b", i) for i in range(7)] and df.rdd.getNumPartitions() == 5
    assert len([f for f in (x.name for x in tmp_path.iterdir()) if f.startswith("a-20.")]) >= 3
    bare = paged.load(spark, paged.paged(fetch, ["a", "b"], "key string, id long", size=10, wait=0.01))
    assert bare.count() == 102 and bare.rdd.getNumPartitions() == 2
    with pytest.raises(Exception, match="busy"):
        paged.load(spark, paged.paged(service({("b", 0): 99}, str(tmp_path))[0], ["b"], "key string, id long", count, tries=2, wait=0.01)).collect()


def test_a_later_run_asks_for_what_was_added(spark, tmp_path):
    folder, to, progress = (str(tmp_path / x) for x in ("service", "to", "progress"))
    (tmp_path / "service").mkdir()
    for n in (25, 25, 61):
        (tmp_path / "service" / "n_a").write_text(str(n))
        fetch, count = service({}, folder)
        source = paged.paged(fetch, ["a"], "key string, id long", count, size=10, pages=2, wait=0.01)
        state.run_to_folder(paged.load(spark, source, stream=True), to, progress).awaitTermination()
        assert sorted(r["id"] for r in spark.read.parquet(to).collect()) == list(range(n))


# search


@pytest.mark.parametrize("block", [1, 5, 128])
def test_sparse_search_equals_the_full_join(spark, block):
    rnd = random.Random(9)
    terms = [(d, t, round(rnd.random() ** 6, 3)) for d in range(300) for t in rnd.sample(range(40), 8)] + [(7, 1, -1.0), (None, 1, 1.0), (8, None, 1.0)]
    queries = [(q, t, round(0.1 + rnd.random(), 3)) for q in range(6) for t in rnd.sample(range(45), 5)] + [(9, 1, -2.0), (10, 999, 1.0)]
    want = {}
    for q in range(6):
        scores = collections.Counter()
        for q2, t, w in queries:
            if q2 == q and w > 0:
                for d, t2, v in terms:
                    if t2 == t and v > 0 and d is not None:
                        scores[d] += w * v
        want[q] = [(d, round(s, 9)) for d, s in sorted(scores.items(), key=lambda x: (-round(x[1], 12), x[0]))[:5]]
    index = sparseindex.SparseIndex.build(spark.createDataFrame(terms, "id long, token_id long, weight double"), block)
    found, used = index.search(spark.createDataFrame(queries, "query_id long, token_id long, w double"), 5)
    got = collections.defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["id"], round(r["score"], 9)))
    assert dict(got) == want
    share = used.agg((F.sum("n_read") / F.sum("n_total")).alias("s")).first()["s"]
    assert share <= 1 and (block > 1 or share < 0.9)
    assert index.search(spark.createDataFrame([], "query_id long, token_id long, w double"), 5)[0].count() == 0


def test_compounds(spark):
    known = {"miete": 50, "vertrag": 80, "mietvertrag": 3, "arbeit": 40, "recht": 90, "arbeitsrecht": 5, "kinder": 30, "garten": 20, "kindergarten": 60, "haft": 9, "pflicht": 9, "versicherung": 9, "haftpflichtversicherung": 2, "zu": 99}
    words = spark.createDataFrame(list(known.items()), "term string, df long")
    got = compounds.of_words(compounds.splits(words), list(known))
    assert got["arbeitsrecht"] == ["arbeit", "recht"] and got["haftpflichtversicherung"] == ["haft", "pflicht", "versicherung"]
    assert "kindergarten" not in got and "mietvertrag" not in got  # commoner than its parts; miet is not known
    assert compounds.splits(words.limit(0)).count() == 0


def test_strategies_of_questions():
    names = [n for n, _, _ in search.strategies("Asyl und Wegweisung")]
    assert any(n.startswith("anchor_") for n in names) and names.index("regeste_focus") < names.index("nl_or") and "title_focus" in names
    runs = search.strategies("Je cherche un arrêt sur le permis de construire d'un parc éolien")
    assert "parc AND eolien" in {q for n, q, _ in runs if n.startswith("anchor_pair_")} and "lang_fr_and" in {n for n, _, _ in runs}
    rare = search.strategies("permis construire parc eolien", frequencies={"permis": 900, "construire": 800, "parc": 5, "eolien": 2}, docs=1000)
    assert [n for n, _, _ in rare if n.startswith("anchor_")] == ["anchor_pair_parc_eolien", "anchor_pair_construire_parc", "anchor_pair_permis_construire", "anchor_eolien", "anchor_parc"]
    expanded = dict((n, q) for n, q, _ in search.strategies("asile renvoi"))["nl_or_expanded"]
    assert "asyl" in expanded and "wegweisung" in expanded and "verkurzte" in search.expansions(["beschleunigtes"])
    for word, wanted in (("hundebiss", "tierhalterhaft"), ("autounfall", "haftpflicht"), ("erbschaft", "erbrecht"), ("geschaeftsfuehrer", "organverantwortlich"), ("mietrecht", "mietzins"), ("asyl", "asile")):
        assert any(wanted in x for x in search.expansions([word])), word
    assert "vertrag" in search.expansions(["mietvertrag"], compounds={"mietvertrag": ["miet", "vertrag"]})
    assert search.query_languages("Je cherche un arrêt sur le permis") == ["fr"] and search.query_languages("xyz") == []


def test_found_decisions_are_fetched_by_id(spark, tmp_path):
    rows = [(f"d{i}", "bger", "CH", f"4A_{i}/2020", "de", "Titel", "", f"wort{i % 50} gemeinsam text nummer{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "decision_id string, court string, canton string, docket_number string, language string, title string, regeste string, full_text string").withColumn("decision_date", F.lit("2020-01-01"))
    fields = [f for f in search.FIELD_WEIGHTS if f in df.columns]
    kept = Index.write(df, str(tmp_path / "ix"), fields, keep=df.columns)
    assert kept.frequencies(["wort7", "gemeinsam", "nie"]) == {"wort7": 60, "gemeinsam": 3000} == Index.of(df, fields).frequencies(["wort7", "gemeinsam", "nie"])
    got = [tuple(r) for r in search.find(df, "wort7 nummer57", index=kept).collect()]
    assert got == [tuple(r) for r in search.find(df, "wort7 nummer57", index=Index.write(df, str(tmp_path / "bare"), fields)).collect()] and got[0][0] == "d57"
    found = kept.fetch(["d1", "d2999", "nie"])
    assert sorted(r["decision_id"] for r in found.collect()) == ["d1", "d2999"] and found.columns == df.columns
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [folder" in plan.replace("isnotnull(folder#", "") or "folder" in plan.split("PartitionFilters")[1][:200]
    assert "In(decision_id" in plan.split("PushedFilters")[1]
    assert kept.fetch([]).count() == 0


# sinks, counts, gates


def test_two_writers_cannot_hide_each_other(spark, tmp_path):
    from lexbrook.sources import sinks

    path = str(tmp_path / "table")
    a, b, c = (spark.createDataFrame([(i,)], "n int") for i in range(3))
    sinks.versioned(a, path, "0", after=-1)
    read = sinks.versions(spark, path)[-1][0]  # both writers have read this one
    sinks.versioned(b, path, "1", after=read)
    with pytest.raises(sinks.CommitConflict):
        sinks.versioned(c, path, "1", after=read)
    assert sinks.current(spark, path).first()["n"] == 1 and len(sinks.versions(spark, path)) == 2
    sinks.versioned(c, path, "2")
    assert [n for n, _, _ in sinks.versions(spark, path)] == [0, 1, 2] and sinks.current(spark, path).first()["n"] == 2


def test_a_court_with_most_rows_is_written_by_several_tasks(spark, tmp_path):
    from lexbrook.sources import sinks

    rows = spark.range(200_000).select(F.when(F.col("id") % 50 == 0, "zh").otherwise("bger").alias("court"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1m")
    try:
        sinks.export(rows.repartition(8), str(tmp_path / "out"))
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "out" / "court=bger").glob("*.parquet"))) > 2
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("court").count().orderBy("court").collect() == rows.groupBy("court").count().orderBy("court").collect()


def test_percentiles_of_a_key_with_most_values(spark):
    from lexbrook.operators import evaluate, traffic

    rnd = random.Random(4)
    rows = [("a" if i % 10 else "b", float(rnd.randint(0, 4000))) for i in range(5000)] + [(None, 3.0), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: (r["n"], r["p50"], r["p95"], r["p99"]) for r in traffic.latency_summary(df, "v", "k").collect()}
    for k in ("a", "b", None):
        v = sorted(x for q, x in rows if q == k and x is not None)
        assert got[k] == (len(v), *(v[int(len(v) * p)] for p in (0.5, 0.95, 0.99)))
    v = sorted(x for _, x in rows if x is not None)
    assert evaluate.latency(df, "v").first()["p95"] == v[int(0.95 * len(v)) - 1]


def test_gates_samples_and_hill_climbing(spark):
    from lexbrook.operators import evaluate, quality

    q = spark.createDataFrame([("1", ["a", "b"]), ("2", ["a"])], "id string, tags array<string>")
    assert evaluate.tag_gates(q, {"a": 2, "b": 2, "c": 1}) == ["b: 1 of 2", "c: 0 of 1"]
    pairs = spark.range(100).select("id")
    one, two = (sorted(r["id"] for r in evaluate.sampled_pairs(pairs, 10, s).collect()) for s in (1, 2))
    assert len(one) == 10 and one != two and one == sorted(r["id"] for r in evaluate.sampled_pairs(pairs.repartition(5), 10, 1).collect())
    best, history = evaluate.hill_climb(lambda c: -abs(c["w"] - 3), {"w": 0.0}, lambda c, i: {"w": c["w"] + 1})
    assert best == {"w": 3.0} and history[0] == -3 and max(history) == 0
    d = spark.createDataFrame([("d1", "2020-01-01", "text" * 200), ("d2", None, ""), ("d3", "2020-02-30", "x" * 900)], "decision_id string, decision_date string, full_text string").withColumn("court", F.lit("bger")).withColumn("regeste", F.lit(""))
    assert len(quality.failed_gates(d, "2024-01-01", 10.0, 10.0)) == 2 and quality.failed_gates(d, "2024-01-01", 100.0, 100.0) == []


def test_cases_by_topic(spark):
    kinds = "area_id string, module_id string, name_de string, name_fr string, title_de string, title_fr string, title_it string, concepts_de array<string>, concepts_fr array<string>, concepts_it array<string>, statutes array<string>, actual_language string, difficulty int, position long"
    none = [None, None, None]
    rows = [("vertrag", "kauf", "Kaufrecht", "Vente", "Kaufvertrag", *none[:2], ["Sachgewährleistung"], None, None, ["Art. 197 OR"], "de", 1, 1), ("miete", "kuendigung", "Miete", "Bail", "Kündigung", *none[:2], ["Mietzins"], None, None, ["Art. 271 OR"], "fr", 3, 2)]
    cases = spark.createDataFrame(rows, kinds)
    scores = {r["module_id"]: r["score"] for r in search.topic_scores(cases, "kauf").collect()}
    assert scores == {"kauf": 5 + 3 + 1, "kuendigung": 0}
    assert search.find_case(cases, "kauf").first()["module_id"] == "kauf" and search.find_case(cases, "nichts").count() == 0
    assert search.find_case(cases, "art. 271", difficulty=1).first()["module_id"] == "kuendigung"
