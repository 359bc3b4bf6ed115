"""State that survives, indexes, ranking and date rules on small tables of their own."""

import pytest
from pyspark.sql import functions as F

from lexbrook.functions import dates, markup, structure
from lexbrook.operators import coverage, evaluate, lineage, repair, resolve, search, vectors
from lexbrook.operators.index import Index
from lexbrook.sources import sinks
from lexbrook.streaming import streams

EVENT = "source_key string, decision_year int, decision_id string, error string"
FILL = " Das Gericht hat in dieser Sache Folgendes erwogen und entschieden."


def test_an_epoch_counts_once_and_a_crash_leaves_the_last_version(spark, tmp_path):
    q = streams.GapQueue(spark, str(tmp_path / "gap"))
    ev = spark.createDataFrame([("s", 2020, "a", "boom")], EVENT)
    assert q.read().count() == 0
    q.apply(ev, 0, "2024-01-01")
    q.apply(ev, 0, "2024-01-01")
    assert [r["retry_count"] for r in q.read().collect()] == [1]
    # written but not committed: nobody sees it
    ev.write.parquet(str(tmp_path / "gap" / "v=1~abc"))
    assert [r["retry_count"] for r in q.read().collect()] == [1]
    q.apply(ev, 1, "2024-01-02")
    assert [r["retry_count"] for r in q.read().collect()] == [2]
    with pytest.raises(FileNotFoundError):
        sinks.current(spark, str(tmp_path / "none"))


def test_the_last_error_by_time_counts(spark):
    rows = [("s", 2020, "a", "early", "2024-01-01"), ("s", 2020, "a", "late", "2024-01-03"), ("s", 2020, "a", "middle", "2024-01-02")]
    for part in (1, 3):
        failed = spark.createDataFrame(rows, EVENT + ", failed_at string").repartition(part)
        got = coverage.apply_failures(spark.createDataFrame([], coverage.QUEUE), failed, "2024-01-04").first()
        assert (got["last_error"], got["retry_count"]) == ("late", 3)


def test_a_cluster_must_name_a_shared_folder(spark):
    assert lineage.shared_folder(spark)


def test_an_index_on_disk_is_that_of_the_table(spark, tmp_path):
    df = spark.createDataFrame([("1", "Der Hund bellt", "ein Hund und noch ein Hund"), ("2", "Die Katze", None), ("3", "", "der Hund der Katze"), (None, "Hund", "Hund")], "decision_id string, title string, full_text string")
    fields = {"title": 6.0, "full_text": 1.2}
    made, kept = Index.of(df, list(fields)), Index.write(df, str(tmp_path / "ix"), list(fields))
    assert made.docs == kept.docs == 3 and made.words == kept.words
    names = ["doc", "field", "term", "tf", "positions", "own", "length"]
    assert sorted(map(str, made.rows.select(names).collect())) == sorted(map(str, kept.rows.select(names).collect()))
    for q in ("hund", "hund NOT bellt", '"hund der"', "kat*", "title:hund", "hund OR katze", "(hund bellt) OR katze", "NOT hund", ""):
        a, b = (search.search(df, q, fields, index=ix).collect() for ix in (made, kept))
        assert [(r["doc"], round(r["score"], 9)) for r in a] == [(r["doc"], round(r["score"], 9)) for r in b]
    assert {r["doc"] for r in search.search(df, '"hund der"', fields, index=kept).collect()} == {"3"}
    assert {r["doc"] for r in search.search(df, "hund NOT bellt", fields, index=kept).collect()} == {"3"}
    plan = kept.asked(["hund"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters")[1][:200] and "In(term" in plan.replace("EqualTo(term", "In(term")
    assert search.search(df, "hund", fields, F.col("decision_id") == "3", index=kept).count() == 1


def test_ranks_without_one_task(spark):
    scores = spark.range(5000).select(F.col("id").alias("doc"), (F.col("id") % 97).cast("double").alias("score")).repartition(7)
    got = search.ranked(scores)
    want = [r["doc"] for r in scores.orderBy(F.desc("score"), "doc").collect()]
    assert [r["doc"] for r in got.orderBy("rank").collect()] == want and got.agg(F.min("rank"), F.max("rank")).first() == (1, 5000)
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()


def test_latency_is_the_element_of_the_sorted_values(spark):
    for values in ([5.0], [float(i * 7 % 101) for i in range(100)], [1.0] * 3000 + [float(i) for i in range(2000)]):
        got = evaluate.latency(spark.createDataFrame([(v,) for v in values], "latency_ms double")).first()
        assert got["p95"] == sorted(values)[max(int(0.95 * len(values)) - 1, 0)] and got["mean"] == pytest.approx(sum(values) / len(values))


@pytest.mark.parametrize(
    "text, date, method, confidence",
    [
        ("Urteil vom 5. März 2019." + FILL + " Lausanne, 9. März 2019", "2019-03-05", "header_de", "medium"), ("Urteil vom 31. Februar 2019." + FILL, None, "", "none"),
        (FILL + " gemäss Verordnung vom 17. Juni 2005 und sonst nichts", None, "", "none"), ("Datum 3.4.2010." + FILL, "2010-04-03", "numeric", "low"), ("zu kurz 3.4.2010", None, "", "none"),
        ("Arrêt no. 28865/17, 19 février 2016." + FILL, "2016-02-19", "echr", "high"), ("Am 7. Juni 2011." + FILL * 10 + " Bern, 8. Juni 2011", "2011-06-08", "signoff", "medium"), (None, None, "", "none"),
    ],
)
def test_which_date_counts(spark, text, date, method, confidence):
    x = spark.createDataFrame([(text,)], "t string").select(dates.decision_date("t").alias("x")).first()["x"]
    assert (x["date"] and str(x["date"]), x["method"], x["confidence"]) == (date, method, confidence)


def test_repairs_keep_what_is_unsure(spark):
    df = spark.createDataFrame([("a", "Urteil vom 5. März 2019." + FILL * 2, "2001-01-01"), ("b", "Datum 3.4.2010." + FILL * 2, "2001-01-01"), ("c", "Urteil vom 5. März 2019." + FILL * 2, None), ("d", "Urteil vom 5. März 2050." + FILL * 2, None)], "decision_id string, full_text string, decision_date string")
    got = {r["decision_id"]: (r["decision_date"], r["publication_date"]) for r in repair.repaired_dates(df, "2024-01-01").collect()}
    assert got == {"a": ("2019-03-05", "2001-01-01"), "b": ("2001-01-01", None), "c": ("2019-03-05", None), "d": (None, None)}


def test_sections_by_all_openings():
    t = "IN DIRITTO\n1. Primo.\npar ces motifs"
    assert structure.sections(t, "it")["method"] == "ranked_it_uppercase"
    s = structure.sections("Sachverhalt\nA.\nErwägungen\nEs ist so.\n1. Die Beschwerde wird als unbegründet abgewiesen.\n2. Die Kosten trägt der Kläger.\nLausanne", "de")
    assert s["orders"] == ["Die Beschwerde wird als unbegründet abgewiesen.", "Die Kosten trägt der Kläger."] and s["erwaegungen"] == "Es ist so."
    s = structure.sections("Faits\nx\nConsidérant:\nAinsi.\n(NR. 12, 3 mars 1990, A. contre B.)", "fr")
    assert s["method"] == "ranked_fr_bare_header" and s["erwaegungen"] == "Ainsi."


def test_lettered_paragraphs_and_pages():
    got = structure.lettered_paragraphs("2. Zweitens\na) klein\naa) kleiner\n2.1\nText\n3.\na) nur Buchstabe")
    assert [(p["number"], p["text"]) for p in got] == [("2", "Zweitens"), ("2.a", "klein"), ("2.aa", "kleiner"), ("2.1", "Text"), ("3.a", "nur Buchstabe")]
    assert structure.lettered_paragraphs(None) == []
    assert markup.page_text("<nav>x</nav><p>a &amp; b<script>if(a<b)</script></p><footer>f") == "a & b" and markup.page_text(None) == ""


def test_signals_of_the_graph_and_a_second_opinion(spark):
    c = spark.createDataFrame([("a",), ("b",), ("c",)], "doc string")
    links = spark.createDataFrame([("a", "c", 2), ("b", "c", 1), ("a", "x", 9)], "source_decision_id string, target_decision_id string, mention_count int")
    got = {r["doc"]: round(r["graph"], 6) for r in search.graph_signals(c, citations=links, cited=["x"]).collect()}
    assert got == {"a": 3.6, "b": 0.0, "c": 1.0}
    scored = c.withColumn("relevance_score", F.lit(1.0))
    assert search.rerank_with(scored, None) is scored
    assert search.rerank_with(scored, lambda d: d.select("doc", (F.col("doc") == "c").cast("double").alias("opinion"))).first()["doc"] == "c"


def test_dockets_of_any_spelling(spark):
    known = spark.createDataFrame([("bger_4A_1_2020", "4A_1/2020"), ("bge_130_II_270", "130 II 270"), ("bge_130_II_2701", "130 II 2701")], "decision_id string, docket_number string")
    refs = spark.createDataFrame([("4A_1/2020",), ("4a.1.2020",), ("BGE 130 II 270",), ("nichts",)], "docket string")
    assert {r["docket"]: r["decision_id"] for r in resolve.by_docket(refs, known).collect()}["4a.1.2020"] == "bger_4A_1_2020"
    assert {r["docket"]: r["decision_id"] for r in resolve.resolved_dockets(refs, known).collect()}["BGE 130 II 270"] == "bge_130_II_270"


def test_sparse_scores_without_a_limit(spark):
    terms = spark.createDataFrame([(i, 0, 1.0) for i in range(30)], "id int, token_id int, weight double")
    q = spark.createDataFrame([(0, 2.0)], "token_id int, w double")
    assert vectors.sparse_search(terms, q, None).count() == 30 and vectors.sparse_search(terms, q, 5).count() == 5
