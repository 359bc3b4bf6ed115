"""Behaviour of operators on small tables of their own."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexbrook.functions import references as R
from lexbrook.functions import structure as S
from lexbrook.functions import text as X
from lexbrook.operators import coverage, dedup, evaluate, graph, quality, search, stats, traffic, vectors
from lexbrook.sources import readers, sinks
from lexbrook.streaming import streams

DECISION = "decision_id string, court string, canton string, docket_number string, language string, decision_date string, title string, regeste string, full_text string, source_id string, scraped_at string, canonical_key string"


def decision(i, court="bger", docket="4A_1/2020", date="2020-05-01", text="Text " * 30, regeste="", title="", language="de", source=None, key=None):
    return (i, court, "CH", docket, language, date, title, regeste, text, source, "2024-01-01", key)


@pytest.fixture
def rows(spark):
    return lambda *r: spark.createDataFrame(list(r), DECISION)


def ids(df, c="decision_id"):
    return sorted(r[c] for r in df.collect())


def test_clean_text_repairs_markup_entities_and_encoding(spark):
    df = spark.createDataFrame([("<p>Zürich &amp; Bern</p>",), ("MÃ¼ller  \t klagt",), ("Ã ungültig ☃",), ("Ã\xff",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(X.clean_text("t")).collect()] == ["Zürich & Bern", "Müller klagt", "Ã ungültig ☃", "Ã\xff", None, ""]


def test_dates(spark):
    df = spark.createDataFrame([("5.3.2019",), ("2019-03-05",), ("5. MÄRZ 2019",), ("1er février 2020",), ("12 dicembre 1999",), ("1750",), ("1999",), ("31.2.2019",), ("",), (None,)], "t string")
    assert [str(r[0]) for r in df.select(X.parse_date("t")).collect()] == ["2019-03-05", "2019-03-05", "2019-03-05", "2020-02-01", "1999-12-12", "None", "1999-01-01", "None", "None", "None"]


def test_keys_join_spellings_of_one_docket(spark):
    df = spark.createDataFrame([("bge", "BGE 125 III 231"), ("bge", "CH_BGE_125_III_231"), ("bl", "BL.2020.1"), ("bl", "BL_2020_1")], "c string, d string")
    keys = [r[0] for r in df.select(X.canonical_key("c", "d", F.lit("2020-05-15"))).collect()]
    assert keys == ["bge|125III231|20200515"] * 2 + ["bl|BL20201|20200515"] * 2


@given(st.text(alphabet="ab-._/19IVX", max_size=12))
@settings(max_examples=8, deadline=None)
def test_docket_form_is_stable(spark, value):
    once = spark.createDataFrame([(value,)], "v string").select(X.docket_norm("v").alias("v"))
    assert once.first()[0] == once.select(X.docket_norm("v").alias("v")).first()[0]


def test_statutes_keep_order_and_drop_words(spark):
    t = "Nach Art. 41 OR und Art. 8 Abs. 2 ZGB, art. 41 OR, Art. 12 der Verordnung, Art. 3bis lit. a StGB; article 5 al. 1 CP."
    found = spark.createDataFrame([(t,)], "t string").select(R.statute_references("t").alias("s")).first()["s"]
    assert [x["normalized"] for x in found] == ["ART.41.OR", "ART.8.ABS.2.ZGB", "ART.3bis.STGB", "ART.5.ABS.1.CP"]


def test_citations_skip_the_inside_of_reports(spark):
    t = "Vgl. BGE 147 I 268 und 131 III 115, Urteil 1A.122/2005 und VB.2018.00411; bge 147 I 268."
    found = spark.createDataFrame([(t,)], "t string").select(R.case_citations("t").alias("s")).first()["s"]
    assert [(x["kind"], x["normalized"]) for x in found] == [("bge", "BGE 147 I 268"), ("docket", "1A_122_2005"), ("docket", "VB_2018_00411"), ("docket", "131 III 115")]


def test_best_version_prefers_headnote_then_length(rows):
    df = rows(decision("a", text="x" * 900, key="k|1|"), decision("b", text="x" * 50, regeste="R", key="k|1|"), decision("c", key="k||2020"), decision("d", key="k||2020"), decision("e", key=None))
    assert ids(dedup.best_version(df)) == ["b", "c", "d", "e"]
    once = dedup.best_version(df)
    assert ids(dedup.best_version(once)) == ids(once)


def test_versions_of_any_date_and_across_courts(rows):
    df = rows(decision("a", key="k|X|2019", text="x" * 100), decision("b", key="k|X|2020", text="x" * 200), decision("c", key="k|Y|2020"))
    assert ids(dedup.best_version_any_date(df)) == ["b", "c"]
    df = rows(decision("a", court="tg_gerichte", docket="Nr. 5", text="x" * 10), decision("b", court="tg_obergericht", docket="5", text="x" * 20), decision("c", court="bger", docket="5"))
    assert ids(dedup.best_across_courts(df)) == ["b", "c"]


def test_first_invalid_copy_blocks_a_later_valid_one(rows):
    df = rows(decision("a", docket=""), decision("b")).withColumn("pos", F.lit(1)).unionByName(rows(decision("a")).withColumn("pos", F.lit(2)))
    assert ids(dedup.export_rows(df, [F.col("pos")])) == ["b"]


def test_cleansing_maps_courts_and_none(rows):
    r = dedup.cleansed(rows(decision("bge_historical_1", court="bge_historical", date="None"))).first()
    assert (r["decision_id"], r["court"], r["decision_date"]) == ("bge_1", "bge", None)


def test_headnote_and_title(spark):
    t = "Urteil\nGegenstand: Forderung aus Vertrag\n\nRegeste:\nEine Regeste von einiger Länge.\nSachverhalt\nA. Text"
    r = spark.createDataFrame([(t,), ("nichts",)], "t string").select(quality.regeste_from_text("t").alias("r"), quality.title_from_text("t").alias("x")).collect()
    assert [tuple(x) for x in r] == [("Eine Regeste von einiger Länge.", "Forderung aus Vertrag"), (None, None)]


def test_resolution_prefers_the_court_that_the_docket_names(spark):
    nodes = spark.createDataFrame([("s", "bger", "CH", "2021-01-01", "X"), ("t1", "bger", "CH", "2020-06-01", "4A_1_2020"), ("t2", "zh", "ZH", "2020-06-01", "4A_1_2020"), ("r", "bge", "CH", "2001-01-01", "127 III 1")], "decision_id string, court string, canton string, decision_date string, docket_norm string")
    edges = spark.createDataFrame([("s", "4A_1_2020", "docket"), ("s", "BGE 127 III 1", "bge"), ("s", "9 IX 9", "docket")], "source_decision_id string, target_ref string, target_type string")
    got = {r["target_decision_id"]: (r["match_type"], r["confidence_score"]) for r in graph.resolve(edges, nodes).collect()}
    assert got["t1"] == ("docket_norm", 0.99) and got["t2"][1] == pytest.approx(0.59) and got["r"][0] == "bge_norm"
    assert all(0.05 <= c <= 0.99 for _, c in got.values())


def test_appeal_chain_ends_on_cycles(spark):
    prior = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b"), ("z", "a")], "decision_id string, prior_id string")
    got = {(r["decision_id"], r["distance"]) for r in graph.appeal_chain(prior, spark.createDataFrame([("a",)], "decision_id string")).collect()}
    assert got == {("a", 0), ("b", -1), ("c", -2), ("z", 1)}
    assert graph.appeal_chain(prior, spark.createDataFrame([("q",)], "decision_id string")).count() == 1


def test_appeal_chain_has_no_last_level(spark):
    prior = spark.createDataFrame([(f"d{i}", f"d{i - 1}") for i in range(1, 20)], "decision_id string, prior_id string")
    got = {(r["decision_id"], r["distance"]) for r in graph.appeal_chain(prior, spark.createDataFrame([("d18",)], "decision_id string")).collect()}
    assert got == {(f"d{i}", i - 18) for i in range(20)}


def test_search_finds_headnotes_before_noise(rows):
    df = rows(decision("1", title="Kündigung des Mietvertrags", regeste="Kündigung der Wohnung"), decision("2", text="Kündigung " + "Wort " * 400), decision("3", title="Steuern"), decision("4", title="Kundigung"))
    got = [r["doc"] for r in search.search(df, "Kündigung").collect()]
    assert got[0] == "1" and got[-1] == "2" and "4" in got and "3" not in got
    assert ids(search.search(df, 'title:"kündigung des" AND NOT steuern'), "doc") == ["1"]
    assert ids(search.search(df, "steu*"), "doc") == ["3"] and search.search(df, '""').count() == 0


def test_find_puts_the_exact_docket_first(rows):
    df = rows(decision("1", docket="4A_291/2017", text="Inhalt"), decision("2", docket="4A_29/2017", text="verweist auf 4A_291/2017 " * 5), decision("3"))
    got = search.find(df, "4A_291/2017")
    assert got.first()["decision_id"] == "1" and "relevance_score" in got.columns and "rank" not in got.columns


def test_query_helpers():
    assert search.intent("4A_1/2020") == "docket" and search.intent('"a b"') == "explicit" and search.intent("recht haben") == "natural"
    assert search.inline_dockets("siehe 4A 291/2017 und E-5/2020") == ["4A_291/2017", "E-5/2020"]
    assert search.docket_family("4A_10/2020", 1) == ["4A_9/2020", "4A_11/2020"]
    assert "resiliation" in search.expansions(["kundigung"]) and search.umlaut_variants("kuendigung") == ["kündigung"]
    assert search.strategies("a AND b")[0][0] == "raw" and search.parse("").kind == "and"


def test_fusion_rises_with_better_ranks(spark):
    def score(rank):
        return search.fuse(spark.createDataFrame([("x", 1.0, "d", rank)], "strategy string, weight double, doc string, rank int")).first()["rrf"]

    assert score(1) > score(2) > score(50)


def test_passages_and_marks(spark):
    df = spark.createDataFrame([("Eins zwei.\n\nDrei zwei eins.",)], "t string")
    assert df.select(search.best_passage("t", ["drei", "eins"])).first()[0] == "Drei zwei eins."
    assert df.select(search.highlight("t", ["EINS"])).first()[0] == "<mark>Eins</mark> zwei.\n\nDrei zwei <mark>eins</mark>."


def test_interleaving(spark):
    a = spark.createDataFrame([("a1", 2.0), ("a2", 1.0)], "doc string, score double")
    b = spark.createDataFrame([("b1", 9.0)], "doc string, score double")
    assert [r["doc"] for r in search.interleave(a, b, 3).collect()] == ["a1", "b1", "a2"]


def test_chunks():
    assert S.chunks(None) == [] and S.chunks("kurz") == ["kurz"]
    t = "Vorspann " * 10 + "\nSachverhalt\n" + "A " * 60 + "\nErwägungen\n" + "B " * 60
    assert [c.split()[0] for c in S.chunks(t)] == ["Vorspann", "Sachverhalt", "Erwägungen"]
    assert len(S.chunks("\n\n".join(["Absatz " * 10] * 7))) == 3
    assert [len(c) for c in S.chunks("x" * 3000)] == [500] * 3


def test_structure_of_a_decision():
    t = "Sachverhalt\nA. Etwas geschah.\nDas Bundesgericht zieht in Erwägung:\n1.\nErstens.\n1.1 Im BGE\n140 III 86 steht.\n2. Zweitens.\nDemnach erkennt das Bundesgericht:\n1. Abgewiesen.\n2. Kosten.\nLausanne, 1. Mai"
    s = S.sections(t, "de")
    assert [p["e_number"] for p in s["paragraphs"]] == ["1", "1.1", "2"] and s["paragraphs"][1]["parent"] == "1"
    assert s["orders"] == ["Abgewiesen.", "Kosten."] and s["sachverhalt"].startswith("A.")
    assert S.numbered_paragraphs("ohne Nummern")[0]["depth"] == 0 and S.sections(None)["orders"] == []
    assert S.study_parts(t)["parse_quality"] == 1.0


def test_prior_instances():
    assert S.prior_instances("Gegenstand\nBeschwerde gegen den Entscheid des Obergerichts vom 13. Nov 2025 (SBK.2025.285).\nSachverhalt:") == ["SBK_2025_285"]
    assert S.prior_instances("recours contre l'arrêt de la Cour de justice du 6 août 2024 (A/1168/2024 - ATA/917/2024).") == ["A_1168_2024", "ATA_917_2024"]
    assert S.prior_instances("Sachverhalt: Mit Urteil vom 14. Juli 2005 wies das Gericht ab (FP240022-L).") == ["FP240022_L"]
    assert S.prior_instances(None) == []


def test_laws():
    got = S.articles("Art. 1\nZweck\nDas Gesetz regelt.\nGeltung\nArt. 2\n1 Es gilt überall.\n§ 3bis Ende")
    assert [(a["article_num"], a["heading"]) for a in got] == [("1", "Zweck"), ("2", "Geltung"), ("3bis", "Ende")] and got[0]["text"] == "Das Gesetz regelt."
    xml = '<a xmlns="x"><article eId="art_5"><num>Art. 5<authorialNote>AS 2020 1</authorialNote></num><heading>H</heading><paragraph><content>Ein <b>Satz</b> hier.</content></paragraph></article><article><num/></article></a>'
    assert S.xml_articles(xml) == [{"article_num": "5", "heading": "H", "text": "Ein Satz hier.", "footnote": "AS 2020 1"}] and S.xml_articles("<a") == []
    assert [p["page_num"] for p in S.debate_pages("x [Page 3] " + "a" * 30 + " [Page 4] kurz")] == [3] and S.debate_pages("ohne")[0]["page_num"] == 1
    assert [p["num"] for p in S.sub_paragraphs("3", "Kopf.\n3.1 eins. 3.2 zwei")] == ["3", "3.1", "3.2"]


def test_gap_queue_rules(spark):
    q = spark.createDataFrame([("s", 2020, "a", "ignored", 2, None, "x", "x", None, None, None), ("s", 2020, "b", "retrying", 1, None, "x", "x", "e", None, None)], coverage.QUEUE)
    failed = spark.createDataFrame([("s", 2020, "a", "boom"), ("s", 2020, "b", "boom"), ("s", 2020, "c", "boom")], "source_key string, decision_year int, decision_id string, error string")
    got = {r["decision_id"]: (r["status"], r["retry_count"], r["next_retry_at"]) for r in coverage.apply_failures(q, failed, "2024-01-01").collect()}
    assert got == {"a": ("ignored", 2, None), "b": ("retrying", 2, "2024-01-02"), "c": ("retrying", 1, "2024-01-02")}
    done = coverage.apply_resolved(q, failed.select("source_key", "decision_year", "decision_id"), "2024-01-03")
    assert {r["decision_id"]: r["status"] for r in done.collect()} == {"a": "ignored", "b": "resolved"}


def test_percentiles_differ_by_definition(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "v double")
    assert df.agg(F.percentile("v", F.lit(0.95))).first()[0] == pytest.approx(9.55)
    assert traffic.latency_summary(df, "v").first()["p95"] == 10.0 and evaluate.latency(df, "v").first()["p95"] == 9.0


def test_suppression_and_noise(spark):
    df = spark.createDataFrame([("a", 5), ("b", 500)], "k string, n int")
    one, two = (traffic.published(df.repartition(p), "n", "k").orderBy("k").collect() for p in (1, 3))
    assert one == two and one[0]["n_public"] is None and abs(one[1]["n_public"] - 500) < 40


def test_sketches_are_near_exact_counts(spark):
    df = spark.range(20_000).select(F.lit("c").alias("client"), F.lpad(F.col("id").cast("string"), 8, "0").alias("cohort"))
    for got in (traffic.hyperloglog(df, "client", "cohort").first()["estimate"], traffic.reach(df, approximate=True).first()["n_cohorts"]):
        assert abs(got - 20_000) < 1200


def test_log_lines(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00 web search GET 200 0.1234 55 abcdefgh",), ("kaputt",), ("2024-01-01T00:00:01 web search GET 500 99.9 x -",)], "value string")
    assert [(r["rtime_ms"], r["bytes"]) for r in traffic.parse_lines(df).collect()] == [(123, 55), (60_000, 0)]
    line = '1.2.3.4 - - [05/Mar/2024:10:00:00 +0100] "GET /api/x HTTP/1.1" 200 12 "-" "curl/8"'
    assert str(traffic.parse_combined(spark.createDataFrame([(line,)], "value string")).first()["ts"]) == "2024-03-05 09:00:00"


def test_nearest_breaks_ties_by_id(spark):
    v = spark.createDataFrame([(3, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (4, None)], "vec_id long, embedding array<float>")
    q = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, query array<float>")
    assert [r["id"] for r in vectors.nearest(v, q, 2).orderBy("rank").collect()] == [1, 3]
    assert [r["id"] for r in vectors.nearest_to(v.where("embedding is not null"), [0.0, 1.0], 1).collect()] == [2]


def test_encoder_takes_each_id_once(spark):
    df = spark.createDataFrame([("a", "eins zwei"), ("a", "eins zwei"), ("b", ""), ("c", None)], "decision_id string, text string")
    assert ids(vectors.encode(df, vectors.hashing_encoder(8)), "id") == ["a"]


def test_metrics_of_a_perfect_and_an_empty_result(spark):
    judged = spark.createDataFrame([(1, "a", 3), (1, "b", 1), (2, "x", 1)], "query_id int, doc string, grade int")
    results = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "query_id int, doc string, rank int")
    got = {r["query_id"]: r for r in evaluate.per_query(results, judged).collect()}
    assert got[1]["ndcg"] == got[1]["ndcg_linear"] == got[1]["ndcg_compressed"] == 1.0 and got[2]["rr"] == 0.0
    assert evaluate.converged([0.5, 0.5, 0.501]) and not evaluate.converged([0.1, 0.5, 0.501])


def test_growth_skips_empty_periods(spark):
    df = spark.createDataFrame([(2000, 0), (2001, 10), (2003, 15)], "year int, n int")
    assert [tuple(r) for r in stats.growth(df).collect()] == [(2003, 50.0)]


def test_readers_and_sinks(spark, tmp_path, rows):
    p = tmp_path / "in"
    p.mkdir()
    (p / "a.jsonl").write_text('{"decision_id": "1", "court": "x"}\nkaputt\n\n{"decision_id": "2"}\n')
    assert ids(readers.jsonl(spark, str(p))) == ["1", "2"] and readers.bad_lines(spark, str(p)).count() == 1
    for body in ('["1", "2"]', '{"decision_ids": ["1", "2"]}', "1\n2\n", '{"decision_id": "1"}\n{"decision_id": "2"}'):
        (tmp_path / "ids").write_text(body)
        assert ids(readers.ids(spark, str(tmp_path / "ids"))) == ["1", "2"], body
    out = str(tmp_path / "daily")
    sinks.daily_shard(rows(decision("a", text="alt"), decision("b")), out, "2024-01-01")
    sinks.daily_shard(rows(decision("a", text="neu")), out, "2024-01-01")
    got = {r["decision_id"]: r["full_text"] for r in spark.read.parquet(out).collect()}
    assert set(got) == {"a", "b"} and got["a"] == "neu"
    sinks.export(rows(decision("a"), decision("b", court="y")), str(tmp_path / "ex"))
    assert spark.read.parquet(str(tmp_path / "ex")).where("court = 'y'").count() == 1
    sinks.versioned(rows(decision("a")), str(tmp_path / "v"), "1")
    assert sinks.current(spark, str(tmp_path / "v")).count() == 1
    sinks.append_new(rows(decision("a"), decision("a")), str(tmp_path / "ap"), ["decision_id"], [F.col("full_text")])
    sinks.append_new(rows(decision("a"), decision("c")), str(tmp_path / "ap"), ["decision_id"], [F.col("full_text")])
    assert ids(spark.read.parquet(str(tmp_path / "ap"))) == ["a", "c"]


def test_streams(spark, tmp_path):
    src, out = tmp_path / "land", str(tmp_path / "out")
    src.mkdir()
    line = '{"decision_id": "%s", "court": "x", "canton": "CH", "docket_number": "1", "language": "de", "full_text": "t"}\n'
    (src / "a.json").write_text(line % "1" + line % "1" + "kaputt\n")
    for name in ("b", "c"):
        streams.ingest(streams.landing(spark, str(src)), out, str(tmp_path / "ck")).awaitTermination()
        (src / f"{name}.json").write_text(line % "1" + line % name)
    assert ids(spark.read.parquet(out)) == ["1", "b"]
    q = streams.GapQueue(spark, str(tmp_path / "gap"))
    ev = spark.createDataFrame([("s", 2020, "a", "boom"), ("s", 2020, "b", None)], "source_key string, decision_year int, decision_id string, error string")
    q.apply(ev, 0, "2024-01-01")
    assert {r["decision_id"]: r["status"] for r in q.read().collect()} == {"a": "retrying"}
