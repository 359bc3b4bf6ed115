"""Readers, sinks, streams and enrichment: files are written from the driver's tables to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import schemas
from ..functions import structure
from ..functions import text as X
from ..operators import coverage, dedup, evaluate, graph, quality, search, stats, traffic
from ..operators.lineage import shared_folder
from ..sources import readers, sinks
from ..streaming import streams
from .base import TODAY, WITH, decisions
from .graph_queries import TARGETS, built
from .registry import query, table


def place(spark, name: str) -> str:
    """A new folder for a query's files, which all machines see."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def records(spark, sf_dir):
    d = decisions(spark, sf_dir)
    return d.select(*(c for c in schemas.DECISION.fieldNames() if c in d.columns))


READ = "decision_id, court, decision_date, md5(full_text) AS text_md5"


def read(df):
    return df.select("decision_id", "court", "decision_date", F.md5("full_text").alias("text_md5"))


@query(f"{WITH} SELECT {READ} FROM decisions")
def jsonl_read(spark, sf_dir):
    p = place(spark, "jsonl")
    records(spark, sf_dir).write.json(p)
    spark.createDataFrame([("kaputt {",), ("",)], "value string").write.mode("append").text(p)
    return read(readers.jsonl(spark, p))


@query(f"{WITH} SELECT {READ} FROM decisions WHERE court IN ('bge', 'bger')")
def shards_read(spark, sf_dir):
    p = place(spark, "export")
    sinks.export(records(spark, sf_dir), p)
    return read(readers.parquet(spark, p, ["decision_id", "court", "decision_date", "full_text"], ["BGE", "bger"]))


@query(f"{WITH} SELECT 'json' AS kind, {READ} FROM decisions WHERE court = 'bvger' UNION ALL SELECT 'parquet', {READ} FROM decisions WHERE court = 'bvger'")
def graph_input_read(spark, sf_dir):
    a, b = place(spark, "gj"), place(spark, "gp")
    records(spark, sf_dir).write.json(a)
    records(spark, sf_dir).write.parquet(b)
    one, two = readers.graph_input(spark, jsonl_path=a, courts=["BVGER"]), readers.graph_input(spark, parquet_path=b, courts=["bvger"])
    return read(one).select(F.lit("json").alias("kind"), "*").unionByName(read(two).select(F.lit("parquet").alias("kind"), "*"))


@query("""SELECT event_type AS client, count(*) AS n, CAST(sum(least(60000, CAST(round_even(event_id % 70 * 1000, 0) AS INTEGER))) AS BIGINT) AS ms, CAST(sum(event_id % 500) AS BIGINT) AS bytes FROM events WHERE strftime(ts, '%Y-%m-%d') = '2024-01-03' GROUP BY 1""")
def log_lines_read(spark, sf_dir):
    p = place(spark, "log")
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    line = F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), "event_type", F.lit("search GET 200"), (k % 70).cast("string"), (k % 500).cast("string"), F.lit("abcdefgh"))
    e.select(line.alias("value")).union(spark.createDataFrame([("2024-01-03 kaputt",)], "value string")).write.option("compression", "gzip").text(p)
    rows = traffic.parse_lines(readers.log_lines(spark, p, "2024-01-03"))
    return rows.groupBy("client").agg(F.count("*").alias("n"), F.sum("rtime_ms").alias("ms"), F.sum("bytes").alias("bytes"))


@query("SELECT '10.0.0.' || (user_id % 200) AS ip, '/api/' || event_type AS path, count(*) AS n, CAST(sum(event_id % 900) AS BIGINT) AS size, min(date_trunc('second', ts)) AS first FROM events GROUP BY 1, 2")
def combined_log_read(spark, sf_dir):
    p = place(spark, "access")
    e = table(spark, sf_dir, "events")
    stamp = F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")
    line = F.concat(F.lit("10.0.0."), (F.col("user_id") % 200).cast("string"), F.lit(" - - ["), stamp, F.lit(' +0000] "GET /api/'), "event_type", F.lit(' HTTP/1.1" 200 '), (F.col("event_id") % 900).cast("string"), F.lit(' "-" "curl/8"'))
    e.select(line.alias("value")).write.text(p)
    rows = traffic.parse_combined(readers.log_lines(spark, p))
    return rows.groupBy("ip", "path").agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.min("ts").cast("timestamp_ntz").alias("first"))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS article_num, n_name AS heading, 'Region ' || n_regionkey || ' gilt.' AS text, 'AS ' || (1990 + n_nationkey) || ' 1' AS footnote FROM nation")
def laws_read(spark, sf_dir):
    p = place(spark, "laws")
    k = F.col("n_nationkey").cast("string")
    xml = F.concat(
        F.lit('<law xmlns="urn:law"><article eId="art_'), k, F.lit('"><num>Art. '), k, F.lit("<authorialNote>AS "), (F.col("n_nationkey") + 1990).cast("string"), F.lit(" 1</authorialNote></num><heading>"), "n_name",
        F.lit("</heading><paragraph><content>Region <b>"), F.col("n_regionkey").cast("string"), F.lit("</b> gilt.</content></paragraph></article></law>"),
    )
    n = table(spark, sf_dir, "nation")
    n.select(xml.alias("value")).repartition(100, "value").write.option("maxRecordsPerFile", 1).text(p)
    return readers.laws(spark, p).select("article_num", "heading", "text", "footnote")


@query("SELECT r_name AS law, CAST(n_nationkey AS VARCHAR) AS article, n_name AS summary, 'Quelle ' || n_nationkey AS source FROM nation JOIN region ON r_regionkey = n_regionkey")
def digests_read(spark, sf_dir):
    p = place(spark, "digests")
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    one = F.struct(F.col("n_nationkey").cast("string").alias("key"), F.struct(F.col("n_name").alias("summary"), F.array(F.concat(F.lit("Quelle "), F.col("n_nationkey").cast("string"))).alias("sources")).alias("value"))
    laws = n.join(F.broadcast(r), F.col("r_regionkey") == F.col("n_regionkey")).groupBy(F.col("r_name").alias("law")).agg(F.map_from_entries(F.collect_list(one)).alias("articles"))  # a row a region
    laws.write.option("maxRecordsPerFile", 1).json(p)
    return readers.digests(spark, p)


@query("SELECT n_name AS id, 'de' AS language, 'Kommentar ' || n_nationkey AS text, 'A. ' || n_regionkey AS author FROM nation")
def commentaries_read(spark, sf_dir):
    p = place(spark, "commentaries")
    n = table(spark, sf_dir, "nation")
    rows = n.select(F.col("n_name").alias("id"), F.lit("OR").alias("law"), F.lit("de").alias("language"), F.concat(F.lit("Kommentar "), F.col("n_nationkey").cast("string")).alias("text"), F.array(F.concat(F.lit("A. "), F.col("n_regionkey").cast("string"))).alias("authors"))
    rows.write.option("maxRecordsPerFile", 1).json(p)
    return readers.commentaries(spark, p).select("id", "language", "text", F.get("authors", F.lit(0)).alias("author"))


@query("SELECT DISTINCT 'd' || o_custkey AS decision_id FROM orders")
def ids_read(spark, sf_dir):
    p = place(spark, "ids")
    table(spark, sf_dir, "orders").select(F.concat(F.lit("d"), F.col("o_custkey").cast("string")).alias("decision_id")).write.json(p)
    return readers.ids(spark, p)


@query("SELECT p_brand AS query, round(sum(p_retailprice), 2) AS ms FROM part WHERE p_size % 2 = 0 GROUP BY 1")
def traces_read(spark, sf_dir):
    p = place(spark, "traces")
    table(spark, sf_dir, "part").select(F.when(F.col("p_size") % 2 == 1, "rerank").otherwise("search").alias("type"), F.col("p_brand").alias("query"), F.col("p_retailprice").alias("total_ms")).write.json(p)
    return readers.traces(spark, p)[0].groupBy("query").agg(F.round(F.sum("total_ms"), 2).alias("ms"))


@query("SELECT r_name AS area_id, n_name AS module_id, 'BGE ' || n_nationkey AS bge_ref, n_nationkey % 3 + 1 AS difficulty FROM nation JOIN region ON r_regionkey = n_regionkey")
def curriculum_read(spark, sf_dir):
    p = place(spark, "curriculum")
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    case = F.array(F.struct(F.concat(F.lit("BGE "), F.col("n_nationkey").cast("string")).alias("bge_ref"), (F.col("n_nationkey") % 3 + 1).cast("int").alias("difficulty")))
    mods = F.collect_list(F.struct(F.col("n_name").alias("id"), F.col("n_name").alias("name_de"), case.alias("cases"))).alias("modules")
    n.join(F.broadcast(r), F.col("r_regionkey") == F.col("n_regionkey")).groupBy(F.col("r_name").alias("area_id")).agg(mods).write.option("maxRecordsPerFile", 1).json(p)  # a row a region
    return readers.curriculum(spark, p).select("area_id", "module_id", "bge_ref", F.col("difficulty").cast("long").alias("difficulty"))


@query("SELECT n_regionkey AS k, n_name AS v FROM nation WHERE n_regionkey < 2 UNION ALL SELECT r_regionkey, r_name FROM region WHERE r_regionkey >= 2")
def first_source_wins(spark, sf_dir):
    n = table(spark, sf_dir, "nation").where("n_regionkey < 2").select(F.col("n_regionkey").alias("k"), F.col("n_name").alias("v"))
    return readers.by_precedence([n, table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("v"))], "k")


# sinks and streams ----------------------------------------------------------------------------


@query(f"{WITH} SELECT substring(scraped_at, 1, 7) AS month, count(*) AS n, count(DISTINCT decision_id) AS ids FROM decisions GROUP BY 1")
def months_compacted(spark, sf_dir):
    a, b = place(spark, "daily"), place(spark, "months")
    d = records(spark, sf_dir)
    sinks.upsert_partitions(d.withColumn("day", F.col("scraped_at")), a, ["decision_id"], "day")
    sinks.compact_months(spark, a, b)
    return spark.read.parquet(b).groupBy(F.col("month").cast("string").alias("month")).agg(F.count("*").alias("n"), F.countDistinct("decision_id").alias("ids"))


@query(f"{WITH} SELECT decision_id, court FROM decisions")
def appended_once(spark, sf_dir):
    p = place(spark, "append")
    d = records(spark, sf_dir)
    for part in (d.where("court <> 'bge'"), d, d.unionByName(d)):
        sinks.append_new(part, p, ["decision_id"], [F.col("scraped_at")])
    return spark.read.parquet(p).select("decision_id", "court")


@query(f"{WITH} SELECT decision_id, 'two' AS version FROM decisions WHERE court = 'bger'")
def version_read(spark, sf_dir):
    p = place(spark, "versions")
    d = decisions(spark, sf_dir).select("decision_id", "court")
    sinks.versioned(d.withColumn("version", F.lit("one")), p, "1")
    sinks.versioned(d.where("court = 'bger'").withColumn("version", F.lit("two")), p, "2")
    return sinks.current(spark, p).select("decision_id", "version")


@query(f"{WITH} SELECT decision_id, court FROM decisions WHERE language IS NOT NULL")
def stream_ingested(spark, sf_dir):
    a, b, c = (place(spark, x) for x in ("landing", "ingested", "progress"))
    d = records(spark, sf_dir)
    d.unionByName(d).write.json(a)
    streams.ingest(streams.landing(spark, a), b, c).awaitTermination()
    return spark.read.parquet(b).select("decision_id", "court")


@query(f"{WITH} SELECT decision_id, CASE WHEN decision_date = 'None' THEN NULL ELSE decision_date END AS decision_date, court FROM decisions")
def cleansed_rows(spark, sf_dir):
    d = records(spark, sf_dir).withColumn("court", F.when(F.col("court") == "bge", "bge_historical").otherwise(F.col("court")))
    return dedup.cleansed(d).select("decision_id", "decision_date", "court")


QUEUED = "SELECT 'd' || doc_id AS decision_id, CASE doc_id % 3 WHEN 0 THEN 'open' WHEN 1 THEN 'retrying' ELSE 'ignored' END AS status FROM documents"


@query(f"SELECT decision_id, CASE WHEN substring(decision_id, 2)::BIGINT % 2 = 0 AND status <> 'ignored' THEN 'resolved' ELSE status END AS status, CASE WHEN substring(decision_id, 2)::BIGINT % 2 = 0 AND status <> 'ignored' THEN 'ingested' END AS resolution FROM ({QUEUED})")
def gaps_resolved(spark, sf_dir):
    d = decisions(spark, sf_dir)
    status = F.when(F.col("doc_id") % 3 == 0, "open").when(F.col("doc_id") % 3 == 1, "retrying").otherwise("ignored")
    key = [F.lit("s").alias("source_key"), F.lit(2024).alias("decision_year"), "decision_id"]
    none = [F.lit(None).cast("string").alias(c) for c in ("next_retry_at", "first_seen_at", "last_seen_at", "last_error", "resolved_at", "resolution")]
    queue = d.select(*key, status.alias("status"), F.lit(0).alias("retry_count"), *none)
    return coverage.apply_resolved(queue, d.where("doc_id % 2 = 0").select(*key), TODAY).select("decision_id", "status", "resolution")


@query("SELECT source AS source_key, max(d) AS last, datediff('day', CAST(max(d) AS DATE), DATE '2024-06-30') AS age FROM (SELECT source, CAST(DATE '2024-06-01' + CAST(doc_id % 25 AS INT) AS VARCHAR) AS d FROM documents) GROUP BY 1 HAVING age > 7")
def stale_sources(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("source_key"), F.date_add(F.lit("2024-06-01").cast("date"), (F.col("doc_id") % 25).cast("int")).cast("string").alias("snapshot_date"))
    return coverage.stale_sources(d, TODAY).select("source_key", "last", F.col("age").cast("long").alias("age"))


@query("""WITH n AS (SELECT n_regionkey AS source_key, 2024 AS snapshot_year, CAST(DATE '2024-01-01' + CAST(n_nationkey % 3 AS INT) AS VARCHAR) AS snapshot_date, count(DISTINCT n_name) AS c FROM nation GROUP BY ALL)
    SELECT CAST(source_key AS VARCHAR) AS source_key, snapshot_date, c AS expected_count FROM n""")
def snapshots_recorded(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n_nationkey") % 3).cast("int")).cast("string")
    new = n.groupBy(F.col("n_regionkey").cast("string").alias("source_key"), day.alias("snapshot_date")).agg(F.concat(F.collect_list("n_name"), F.collect_list("n_name")).alias("expected_ids"))
    new = new.withColumn("snapshot_year", F.lit(2024))
    old = spark.createDataFrame([], schemas.SNAPSHOT).unionByName(new.limit(3).withColumn("expected_count", F.lit(-1)), allowMissingColumns=True)
    return coverage.record_snapshot(old, new).select("source_key", "snapshot_date", F.col("expected_count").cast("long").alias("expected_count"))


# enrichment -----------------------------------------------------------------------------------

NOTE = "'Eine Regeste von einiger Länge zur Sache ' || doc_id || ', die hier in voller Länge wiedergegeben ist.'"


@query(f"{WITH} SELECT decision_id, CASE WHEN court IN ('bger', 'bge') AND length(trim(coalesce(regeste, ''))) = 0 THEN {NOTE} ELSE regeste END AS regeste, 'Forderung ' || doc_id || ' aus Vertrag' AS title, md5('Urteil' || chr(10) || 'Gegenstand: Forderung ' || doc_id || ' aus Vertrag' || chr(10) || chr(10) || 'Regeste:' || chr(10) || {NOTE} || chr(10) || 'Sachverhalt' || chr(10) || full_text || repeat(' x', 120)) AS content_hash FROM decisions")
def enriched(spark, sf_dir):
    k = F.col("doc_id").cast("string")
    note = F.concat(F.lit("Eine Regeste von einiger Länge zur Sache "), k, F.lit(", die hier in voller Länge wiedergegeben ist."))
    body = F.concat(F.lit("Urteil\nGegenstand: Forderung "), k, F.lit(" aus Vertrag\n\nRegeste:\n"), note, F.lit("\nSachverhalt\n"), "full_text", F.lit(" x" * 120))
    d = decisions(spark, sf_dir).withColumns({"full_text": body, "title": F.lit(""), "content_hash": F.lit("")})
    out = quality.with_content_hash(quality.with_title(quality.with_regeste(d)))
    return out.select("decision_id", "regeste", "title", "content_hash")


@query(f"{WITH} SELECT decision_id, CASE WHEN length(trim(coalesce(regeste, ''))) = 0 THEN {NOTE} ELSE regeste END AS regeste FROM decisions")
def short_headnotes(spark, sf_dir):
    k = F.col("doc_id").cast("string")
    note = F.concat(F.lit("Eine Regeste von einiger Länge zur Sache "), k, F.lit(", die hier in voller Länge wiedergegeben ist."))
    d = decisions(spark, sf_dir).withColumn("full_text", F.concat(F.lit("Regeste (a):\n"), note, F.lit("\nSachverhalt\n"), "full_text"))
    return quality.with_short_regeste(d).select("decision_id", "regeste")


@query("SELECT doc_id, 'Müller ' || doc_id AS fixed FROM documents")
def encodings_fixed(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.fix_mojibake(F.concat(F.lit("MÃ¼ller "), F.col("doc_id").cast("string"))).alias("fixed"))


@query("SELECT doc_id, 'Kündigung der Wohnung ' || doc_id AS terms FROM documents")
def headnote_terms(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.query_terms(F.concat(F.lit("Regeste\nKündigung der  Wohnung "), F.col("doc_id").cast("string"), F.lit(" Art 271 OR. Der Rest fällt weg."))).alias("terms"))


@query("SELECT doc_id, true AS positive FROM documents")
def stable_ids(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", ((X.stable_id("doc_id") >= 0) & (X.stable_id("doc_id") < (1 << 31))).alias("positive"))


@query(f"""{TARGETS}, o AS (SELECT CAST('cites' AS VARCHAR) AS side, tgt AS id FROM targets WHERE src = 'd5' AND conf >= 0.3 UNION SELECT 'cited_by', src FROM targets WHERE tgt = 'd5' AND conf >= 0.3)
    SELECT 'd5' AS decision_id, 'ART.6.ABS.2.OR;ART.6.ZGB' AS statutes, coalesce((SELECT string_agg(id, ';' ORDER BY id) FROM o WHERE side = 'cites'), '') AS cites, coalesce((SELECT string_agg(id, ';' ORDER BY id) FROM o WHERE side = 'cited_by'), '') AS cited_by""")
def case_brief(spark, sf_dir):
    d, edges, links = built(spark, sf_dir)
    statutes = graph.statute_edges(d, F.col("refs"))
    b = graph.case_brief(d.select("decision_id"), edges, links.about("d5"), statutes, "d5")
    joined = lambda c: F.array_join(F.coalesce(F.col(c), F.array().cast("array<string>")), ";").alias(c)
    return b.select("decision_id", joined("statutes"), joined("cites"), joined("cited_by"))


@query(f"""{TARGETS}, m AS (SELECT 'd' || doc_id AS id FROM documents WHERE doc_id % 30 + 1 = 9), c AS (SELECT tgt, count(DISTINCT src) AS n FROM targets GROUP BY 1), b AS (SELECT id, coalesce(n, 0) AS n FROM m LEFT JOIN c ON c.tgt = m.id ORDER BY n DESC, id LIMIT 20)
    SELECT id AS decision_id, n AS citations, d.decision_date FROM b JOIN decisions d ON d.decision_id = b.id""")
def doctrine_timeline(spark, sf_dir):
    d, _, links = built(spark, sf_dir)
    return graph.doctrine_timeline(d, graph.statute_edges(d, F.col("refs")), links, "ART.9.ZGB").select("decision_id", "citations", "decision_date")


@query("SELECT doc, rank, corpus FROM (SELECT p_partkey AS doc, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS rank, 0 AS corpus FROM part UNION ALL SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey), 1 FROM customer) ORDER BY rank, corpus LIMIT 30")
def interleaved(spark, sf_dir):
    a = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc"), F.col("p_retailprice").alias("score"))
    b = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc"), F.col("c_acctbal").alias("score"))
    return search.interleave(a, b, 30).select("doc", "rank", "corpus")


@query("SELECT n_name || CASE WHEN i > 0 THEN '__' || (i + 1) ELSE '' END AS id, i AS k FROM nation, (VALUES (0), (1), (2)) v(i)")
def merged_goldens(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("id"))
    return evaluate.merged_goldens([n.withColumn("k", F.lit(i)) for i in range(3)]).select("id", "k")


@query("SELECT p_partkey AS query_id, p_retailprice AS rr FROM part ORDER BY rr, query_id LIMIT 15")
def worst_queries(spark, sf_dir):
    return evaluate.worst(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("query_id"), F.col("p_retailprice").alias("rr")), 15)


@query("SELECT p_brand AS area_id, p_size AS module_id, count(*) AS n FROM part GROUP BY 1, 2")
def cases_by_area(spark, sf_dir):
    return stats.counted(table(spark, sf_dir, "part").select(F.col("p_brand").alias("area_id"), F.col("p_size").alias("module_id")), "area_id", "module_id").select("area_id", "module_id", "n")


@query("""SELECT count(*) AS decisions, round(100.0 * count(CASE WHEN doc_id % 2 = 0 THEN 1 END) / count(*), 1) AS pct_sachverhalt, round(100.0 * count(CASE WHEN doc_id % 3 = 0 THEN 1 END) / count(*), 1) AS pct_erwaegungen,
    round(100.0 * count(CASE WHEN doc_id % 5 = 0 THEN 1 END) / count(*), 1) AS pct_dispositiv, round(avg(doc_id % 3), 2) AS mean_paragraphs FROM documents""")
def section_shares(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("decision_id", F.col("doc_id").cast("string"))
    has = lambda n: F.when(F.col("doc_id") % n == 0, "x").otherwise("")
    found = d.select("decision_id", has(2).alias("sachverhalt"), has(3).alias("erwaegungen"), has(5).alias("dispositiv"))
    paragraphs = d.select("decision_id", F.explode(F.when(F.col("doc_id") % 3 == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), (F.col("doc_id") % 3).cast("int")))).alias("k"))
    return structure.section_ratios(found, paragraphs)


@query("SELECT doc_id, unnest(['3', '3.a', '3.b', '3.1', '4']) AS number FROM documents")
def lettered_paragraphs(spark, sf_dir):
    flat = F.regexp_replace("text", r"\s+", " ")
    body = F.concat(F.lit("3. Zur Sache.\na) "), F.lit("Erstens "), flat, F.lit("\nb) Zweitens.\n3.1\nText.\n4. Ende."))
    return structure.table_of(table(spark, sf_dir, "documents").select("doc_id", body.alias("t")), structure.lettered_paragraphs, "number string, depth int, text string", "doc_id", "t").select("doc_id", "number")


@query("SELECT page_id, length(t) > 0 AS has_text, regexp_matches(t, '<script|<style') AS markup FROM (SELECT page_id, CASE WHEN html IS NULL OR html = '' THEN '' ELSE 'x' END AS t FROM pages)")
def pages_parsed(spark, sf_dir):
    from ..functions import markup

    t = markup.text_of(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", t.alias("t")).select("page_id", (F.length("t") > 0).alias("has_text"), F.col("t").rlike("<script|<style").alias("markup"))


@query("SELECT p_partkey, 'Absatz ' || p_partkey || ' gilt.' AS fragment FROM part")
def article_fragments(spark, sf_dir):
    page = F.concat(F.lit('<html><article id="art_5_bis" class="x"><h6 class="heading">Art. 5bis</h6><div class="collapseable">Absatz '), F.col("p_partkey").cast("string"), F.lit(' gilt.</div><a name="a5"></a></article><article id="art_6">anderes hier</article>'))
    return table(spark, sf_dir, "part").select("p_partkey", structure.article_fragment(page, "5bis").alias("fragment"))
