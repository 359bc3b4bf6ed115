"""References, tags, laws and materials over derived decisions and the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import structure
from ..functions import text as X
from ..operators import graph, library, quality, resolve, search, traffic
from .base import WITH, decisions
from .registry import query, table
from .search_queries import TEXT_ONLY, TOK, WORDS, bm25_sql, indexed

#: Lists of dockets, one for each order: one that is there, one report, and one that is not.
LISTS = "SELECT o_orderkey, 'Art. ' || (o_orderkey % 12 + 1) AS label, '4A_' || (o_orderkey % 200) || '/2019' AS d1, 'BGE ' || (100 + o_orderkey % 50) || ' III ' || (o_orderkey % 200) AS d2 FROM orders"


def lists(spark, sf_dir):
    k = F.col("o_orderkey")
    d1 = F.concat(F.lit("4A_"), (k % 200).cast("string"), F.lit("/2019"))
    d2 = F.concat(F.lit("BGE "), (100 + k % 50).cast("string"), F.lit(" III "), (k % 200).cast("string"))
    body = F.concat(F.lit("Vgl. "), d1, F.lit(" sowie "), d2, F.lit(" und 9Z_999/1999, nochmals "), d1, F.lit("."))
    label = resolve.article_label(F.concat(F.lit("Art"), (k % 12 + 1).cast("string"), F.lit(".pdf")))
    return table(spark, sf_dir, "orders").select("o_orderkey", label.alias("label"), body.alias("text"))


@query(f"SELECT o_orderkey, label, array_to_string(list_sort([d1, d2, '9Z_999/1999']), ';') AS dockets FROM ({LISTS})")
def tag_dockets(spark, sf_dir):
    return lists(spark, sf_dir).select("o_orderkey", "label", F.array_join(resolve.dockets_in("text"), ";").alias("dockets"))


#: Decisions whose ids hold the report's place, as the ids of reports do.
NAMED = f"{WITH}, named AS (SELECT CASE WHEN court = 'bge' THEN 'bge_' || regexp_replace(replace(docket_number, 'BGE ', ''), ' ', '_', 'g') || '_' || doc_id ELSE decision_id END AS decision_id, docket_number, regeste, full_text FROM decisions)"


def named(spark, sf_dir):
    d = decisions(spark, sf_dir)
    own = F.concat(F.lit("bge_"), F.regexp_replace(F.replace("docket_number", F.lit("BGE "), F.lit("")), " ", "_"), F.lit("_"), F.col("doc_id").cast("string"))
    return d.withColumn("decision_id", F.when(F.col("court") == "bge", own).otherwise(F.col("decision_id")))


@query(f"""{NAMED}, l AS ({LISTS}), r AS (SELECT label, unnest([d1, d2]) AS d FROM l), e AS (SELECT docket_number AS k, min(decision_id) AS id FROM named GROUP BY 1),
    b AS (SELECT regexp_extract(decision_id, '^(bge_[0-9]+_[A-Z]+_[0-9]+)_', 1) AS k, min(decision_id) AS id FROM named WHERE decision_id LIKE 'bge%' GROUP BY 1)
    SELECT DISTINCT label, CASE WHEN d LIKE 'BGE%' THEN b.id ELSE e.id END AS decision_id FROM r LEFT JOIN e ON e.k = d LEFT JOIN b ON b.k = 'bge_' || replace(substring(d, 5), ' ', '_')
    WHERE CASE WHEN d LIKE 'BGE%' THEN b.id ELSE e.id END IS NOT NULL""")
def tags_resolved(spark, sf_dir):
    return resolve.tags(lists(spark, sf_dir), named(spark, sf_dir))


PLAIN = "regexp_replace(lower({0}), '[^0-9a-z]', '', 'g')"


@query(f"""{WITH}, r AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '4A_' || (o_orderkey % 400) || '/2019' WHEN 1 THEN '4a.' || (o_orderkey % 400) || '.2019' ELSE 'lb' || (o_orderkey % 80) || ' u' END AS docket FROM orders),
    e AS (SELECT docket_number AS k, min(decision_id) AS id FROM decisions GROUP BY 1), p AS (SELECT {PLAIN.format("docket_number")} AS k, min(decision_id) AS id FROM decisions GROUP BY 1)
    SELECT o_orderkey, coalesce(e.id, p.id) AS decision_id FROM r LEFT JOIN e ON e.k = r.docket LEFT JOIN p ON p.k = {PLAIN.format("r.docket")}""")
def dockets_looked_up(spark, sf_dir):
    k = F.col("o_orderkey")
    docket = F.when(k % 3 == 0, F.concat(F.lit("4A_"), (k % 400).cast("string"), F.lit("/2019"))).when(k % 3 == 1, F.concat(F.lit("4a."), (k % 400).cast("string"), F.lit(".2019"))).otherwise(F.concat(F.lit("lb"), (k % 80).cast("string"), F.lit(" u")))
    return resolve.by_docket(table(spark, sf_dir, "orders").select(k, docket.alias("docket")), decisions(spark, sf_dir)).select("o_orderkey", "decision_id")


@query(f"""{WITH}, w AS (SELECT DISTINCT CASE o_orderkey % 3 WHEN 0 THEN 'd' || (o_orderkey % 300) WHEN 1 THEN 'bger_4A_' || (o_orderkey % 400) || '_2019' ELSE 'nichts_' || (o_orderkey % 7) END AS r FROM orders),
    p AS (SELECT {PLAIN.format("docket_number")} AS k, min(decision_id) AS id FROM decisions GROUP BY 1)
    SELECT r AS relevant_id, coalesce(d.decision_id, CASE WHEN r LIKE 'bger%' THEN p.id END) AS decision_id FROM w LEFT JOIN decisions d ON d.decision_id = r LEFT JOIN p ON p.k = {PLAIN.format("substring(r, 6)")}""")
def relevant_ids(spark, sf_dir):
    k = F.col("o_orderkey")
    r = F.when(k % 3 == 0, F.concat(F.lit("d"), (k % 300).cast("string"))).when(k % 3 == 1, F.concat(F.lit("bger_4A_"), (k % 400).cast("string"), F.lit("_2019"))).otherwise(F.concat(F.lit("nichts_"), (k % 7).cast("string")))
    return resolve.relevant_ids(table(spark, sf_dir, "orders").select(r.alias("relevant_id")), decisions(spark, sf_dir))


@query(f"""{WITH}, c AS (SELECT p_partkey, (100 + p_partkey % 50) || ' III ' || (p_partkey % 200) AS k FROM part), b AS (SELECT replace(docket_number, 'BGE ', '') AS k, min(decision_id) AS id FROM decisions WHERE court = 'bge' GROUP BY 1)
    SELECT p_partkey, id AS decision_id FROM c LEFT JOIN b USING (k)""")
def curriculum_resolved(spark, sf_dir):
    k = F.col("p_partkey")
    ref = F.concat(F.lit("ATF "), (100 + k % 50).cast("string"), F.lit(" iii "), (k % 200).cast("string"))
    return resolve.curriculum_ids(table(spark, sf_dir, "part").select(k, ref.alias("bge_ref")), decisions(spark, sf_dir)).select("p_partkey", "decision_id")


@query(f"""{WITH}, r AS (SELECT DISTINCT o_custkey AS doc, '4A_' || (o_orderkey % 400) || '/2019' AS ref FROM orders), k AS (SELECT upper(docket_number) AS k, min(decision_id) AS id, bool_or(trim(full_text) <> '') AS t FROM decisions GROUP BY 1)
    SELECT doc, ref, id AS decision_id, id IS NOT NULL AS found, coalesce(t, false) AS has_text FROM r LEFT JOIN k ON k.k = upper(ref)""")
def document_scan(spark, sf_dir):
    refs = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), F.concat(F.lit("4A_"), (F.col("o_orderkey") % 400).cast("string"), F.lit("/2019")).alias("ref"))
    return resolve.scanned(refs, decisions(spark, sf_dir))


@query(f"""{WITH}, n AS (SELECT decision_id, substring(regeste, 1, 200) AS note FROM decisions WHERE length(regeste) >= 50), l AS (SELECT DISTINCT 'd' || (doc_id + 3) AS s, 'd' || doc_id AS t FROM documents)
    SELECT note AS query, t AS target_id, s AS source_id FROM l JOIN n ON n.decision_id = s WHERE t IN (SELECT decision_id FROM n)""")
def headnote_pairs(spark, sf_dir):
    d = decisions(spark, sf_dir)
    links = d.select(F.concat(F.lit("d"), (F.col("doc_id") + 3).cast("string")).alias("source_decision_id"), F.col("decision_id").alias("target_decision_id"))
    return resolve.headnote_pairs(links, d)


#: Laws and their articles out of the star schema: brands are laws, parts are articles.
ARTICLES = "SELECT p_partkey AS article_id, p_brand AS sr_number, p_type AS title, p_type AS abbreviation, CAST(p_size AS VARCHAR) AS article_num, p_name AS text FROM part"


def articles(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("article_id"), F.col("p_brand").alias("sr_number"), F.col("p_type").alias("title"), F.col("p_type").alias("abbreviation"), F.col("p_size").cast("string").alias("article_num"), F.col("p_name").alias("text"))


@query(f"SELECT sr_number, min(title) AS title, count(*) AS articles FROM ({ARTICLES}) GROUP BY 1 ORDER BY articles DESC, sr_number LIMIT 20")
def top_laws(spark, sf_dir):
    return library.top_laws(articles(spark, sf_dir))


@query(f"SELECT sr_number AS law, title AS language, count(*) AS n, count(DISTINCT article_num) AS articles, min(text) AS author FROM ({ARTICLES}) GROUP BY 1, 2")
def commentaries_by_law(spark, sf_dir):
    return library.commentaries_by_law(articles(spark, sf_dir).select(F.col("sr_number").alias("law"), F.col("title").alias("language"), "article_num", F.col("text").alias("author")))


@query(f"""WITH a AS ({ARTICLES}), l AS (SELECT upper(trim(abbreviation)) AS k, min((sr_number, title)) AS x FROM a GROUP BY 1)
    SELECT article_id, x[1] AS sr_number, x[2] AS law_title FROM a LEFT JOIN l ON l.k = upper(trim(a.abbreviation))""")
def articles_with_law(spark, sf_dir):
    a = articles(spark, sf_dir)
    lower = a.select("article_id", F.concat(F.lit(" "), F.lower("abbreviation")).alias("abbreviation"))
    return library.with_law(lower, a).select("article_id", "sr_number", "law_title")


@query(f"SELECT article_id, sr_number, text FROM ({ARTICLES}) WHERE upper(sr_number) = upper('Brand#10') AND article_num = '6'")
def law_article(spark, sf_dir):
    return library.article_of(articles(spark, sf_dir), "Brand#10", "6").select("article_id", "sr_number", "text")


@query("SELECT CASE doc_id % 4 WHEN 0 THEN 'AS' WHEN 1 THEN 'BBl' WHEN 2 THEN 'FF' ELSE 'RO' END AS kind, count(*) AS n, CAST(min(1990 + doc_id % 30) AS INTEGER) AS first_year, CAST(max(1990 + doc_id % 30) AS INTEGER) AS last_year FROM documents GROUP BY 1")
def amendments_by_kind(spark, sf_dir):
    from .text_queries import amendment_references

    return library.amendments_by_kind(amendment_references(spark, sf_dir))


@query(f"{WITH} SELECT 'decisions' AS corpus, count(*) AS n, count(DISTINCT canton) AS cantons FROM decisions UNION ALL SELECT 'pages', count(*), 0 FROM pages UNION ALL SELECT 'laws', count(*), 0 FROM part")
def corpus_counts(spark, sf_dir):
    return library.corpus_counts({"decisions": decisions(spark, sf_dir), "pages": table(spark, sf_dir, "pages"), "laws": articles(spark, sf_dir)})


@query("SELECT 'd' || doc_id AS decision_id, unnest(['ART.' || (doc_id % 50 + 1) || '.ABS.' || (doc_id % 4 + 1) || '.OR', 'ART.' || (doc_id % 30 + 1) || '.ZGB']) AS statute_id FROM documents UNION SELECT 'd' || doc_id, 'ART.' || (doc_id % 60 + 1) || '.ZGB' FROM documents")
def merged_statutes(spark, sf_dir):
    d = decisions(spark, sf_dir)
    given = d.select("decision_id", F.concat(F.lit("ART."), (F.col("doc_id") % 60 + 1).cast("string"), F.lit(".ZGB")).alias("statute_id"))
    return library.merged_statutes(given, graph.statute_edges(d, F.col("refs")))


@query("SELECT decision_id, full_text FROM (SELECT 'd' || doc_id AS decision_id, text AS full_text FROM documents) WHERE decision_id = 'd17'")
def decision_by_id(spark, sf_dir):
    return search.by_id(decisions(spark, sf_dir), "d17").select("decision_id", "full_text")


@query(f"WITH w AS (SELECT doc_id, {TOK} AS t FROM documents) SELECT count(*) AS total FROM w WHERE list_contains(t, 'trash') AND NOT list_contains(t, 'clown')")
def search_total(spark, sf_dir):
    return search.total(decisions(spark, sf_dir), "trash NOT clown", TEXT_ONLY, index=indexed(spark, sf_dir))


@query(f"{WITH} SELECT count(*) AS groups, coalesce(sum(n), 0) AS rows FROM (SELECT count(*) AS n FROM decisions GROUP BY court, docket_number, decision_date HAVING count(*) > 1)")
def duplicate_group_count(spark, sf_dir):
    return quality.count_of_duplicate_groups(decisions(spark, sf_dir), "court", "docket_number", "decision_date")


@query("SELECT event_type, count(CASE WHEN CAST(ts AS VARCHAR) LIKE '2024-01-03%' THEN 1 END) AS today, count(*) AS ever FROM events GROUP BY 1")
def feature_usage(spark, sf_dir):
    return traffic.feature_usage(table(spark, sf_dir, "events"), "2024-01-03", "event_type", "ts")


@query("SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 10")
def last_uses(spark, sf_dir):
    return traffic.last_uses(table(spark, sf_dir, "events"), 10, "ts", "event_id").select("event_id", "event_type")


@query("SELECT event_type AS client, max(n) AS reach FROM (SELECT event_type, CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS n FROM events GROUP BY 1, 2) GROUP BY 1")
def highest_reach(spark, sf_dir):
    daily = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("client"), F.to_date("ts").alias("day")).agg(F.countDistinct("user_id").alias("n_cohorts"))
    return traffic.highest_reach(daily)


@query("SELECT event_type AS client, least(count(DISTINCT user_id), 50) AS n_cohorts, count(DISTINCT user_id) > 50 AS more FROM events GROUP BY 1")
def reach_told(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("client"), F.lpad(F.col("user_id").cast("string"), 8, "0").alias("cohort"))
    return traffic.reach_told(rows, most=50)


@query("SELECT unnest(['all', 'big', 'clicks']) AS period, unnest([count(*), count(CASE WHEN value > 50 THEN 1 END), count(CASE WHEN event_type = 'click' THEN 1 END)]) AS n FROM events")
def usage_totals(spark, sf_dir):
    return traffic.usage_totals(table(spark, sf_dir, "events"), {"all": F.lit(True), "big": F.col("value") > 50, "clicks": F.col("event_type") == "click"})


@query("SELECT event_type, count(*) AS n, round(100.0 * count(CASE WHEN value > 10 THEN 1 END) / count(*), 2) AS ok_pct, round(100.0 * count(CASE WHEN value < 1 THEN 1 END) / count(*), 2) AS empty_pct FROM events GROUP BY 1")
def call_rates(spark, sf_dir):
    return traffic.rates(table(spark, sf_dir, "events"), "event_type", ok=F.col("value") > 10, empty=F.col("value") < 1)


@query("SELECT DISTINCT client FROM (SELECT event_type AS client FROM events UNION ALL SELECT source FROM documents)")
def all_clients(spark, sf_dir):
    return traffic.all_clients(table(spark, sf_dir, "events").select(F.col("event_type").alias("client")), table(spark, sf_dir, "documents").select(F.col("source").alias("client")))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'SBK_' || doc_id || '_285' WHEN 1 THEN 'A_' || doc_id || '_2024;ATA_917_2024' WHEN 2 THEN 'FP240022_L' ELSE '' END AS prior FROM documents")
def prior_instances(spark, sf_dir):
    k = F.col("doc_id").cast("string")
    said = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("Gegenstand\nBeschwerde gegen den Entscheid des Obergerichts vom 13. Nov 2025 (SBK."), k, F.lit(".285).\nSachverhalt:")))
    said = said.when(F.col("doc_id") % 4 == 1, F.concat(F.lit("recours contre l'arrêt de la Cour de justice du 6 août 2024 (A/"), k, F.lit("/2024 - ATA/917/2024).")))
    said = said.when(F.col("doc_id") % 4 == 2, "Sachverhalt: Mit Urteil vom 14. Juli 2005 wies das Gericht ab (FP240022-L).").otherwise("")
    # dockets need two digits or more, which ids get here
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("\n", F.when(F.col("doc_id") % 4 < 2, F.regexp_replace(said, r"\b(\d)\b(?=[./])", "$1")).otherwise(said), "text").alias("t"))
    return d.select("doc_id", F.array_join(structure.prior_instances_of(F.col("t")), ";").alias("prior"))


@query(r"""SELECT doc_id, array_to_string([x for x in [regexp_replace(y, '^\s+|\s+$', '', 'g') for y in ['Die Beschwerde wird abgewiesen.', 'Kosten: ' || replace(text, chr(10), ' ')]] if x <> ''], '|') AS orders FROM documents""")
def orders_split(spark, sf_dir):
    flat = F.replace("text", F.lit("\n"), F.lit(" "))
    body = F.concat(F.lit("\n1. Die Beschwerde wird abgewiesen.\n 2. Kosten: "), flat, F.lit("\nLausanne, 1. Mai 2020\nDer Präsident"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(structure.orders_of(body), "|").alias("orders"))


@query("SELECT doc_id, 'Das Bundesgericht, hier.' AS facts, CASE doc_id % 3 WHEN 0 THEN 'ranked_de_header' WHEN 1 THEN 'ranked_fr_considere_TF' ELSE 'ranked_it_uppercase' END AS method, CASE doc_id % 3 WHEN 0 THEN 'ranked_de_BGer' WHEN 1 THEN 'fallback_fr_lc_prononce' ELSE 'fallback_it_TF_loose' END AS dispositiv_method, 'Erstens.|Zweitens.' AS orders FROM documents")
def sections_found(spark, sf_dir):
    pick = lambda *x: F.element_at(F.array(*map(F.lit, x)), (F.col("doc_id") % 3).cast("int") + 1)
    body = F.concat(
        pick("Sachverhalt", "Faits", "Fatti"), F.lit("\nDas Bundesgericht, hier.\n"), pick("Erwägungen:", "Le Tribunal fédéral considère en droit:", "IN DIRITTO"), F.lit("\n"), "text", F.lit("\n"),
        pick("Demnach erkennt das Bundesgericht:", "Par ces motifs, prononce :", "Per questi motivi, il Tribunale federale"), F.lit("\n1. Erstens.\n2. Zweitens.\nLausanne"),
    )
    d = table(spark, sf_dir, "documents").select("doc_id", body.alias("full_text"), pick("de", "fr", "it").alias("language"))
    return structure.sections_of(d).select("doc_id", F.col("sachverhalt").alias("facts"), "method", "dispositiv_method", F.array_join("orders", "|").alias("orders"))


@query("SELECT c_custkey, 'x_' || c_custkey AS bare, array_to_string(['- ' || c_name, '- ' || c_mktsegment], chr(10)) AS bullets, '[\"' || c_name || '\"]' AS listed FROM customer")
def small_forms(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", F.concat(F.lit("x_"), F.col("c_custkey").cast("string")).alias("bare"), X.bullets(F.array("c_name", "c_mktsegment")).alias("bullets"), X.as_json_list(F.array("c_name")).alias("listed"))


@query("SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber) AS place FROM lineitem")
def numbers_in_order(spark, sf_dir):
    """Hierarchical numbers sort by their parts: 1.10 after 1.9."""
    from pyspark.sql import Window

    number = F.concat(F.lit("1."), F.col("l_quantity").cast("int").cast("string"), F.lit("."), F.col("l_linenumber").cast("string"))
    w = Window.partitionBy("l_orderkey").orderBy("k")
    return table(spark, sf_dir, "lineitem").withColumn("k", structure.by_number(number)).select("l_orderkey", "l_linenumber", F.row_number().over(w).alias("place"))


def corpus_sql(where: str, corpus: int) -> str:
    words = WORDS.replace("FROM documents", f"FROM documents WHERE {where}")
    return f"(SELECT doc, score, row_number() OVER (ORDER BY score DESC, doc) AS rank, {corpus} AS corpus FROM (WITH {words}, {bm25_sql(['trash', 'idiot', 'dans'])} SELECT doc, score FROM b ORDER BY score DESC, doc LIMIT 20))"


@query(f"SELECT doc, round(score, 6) AS score, rank FROM (SELECT * FROM {corpus_sql('doc_id % 3 > 0', 0)} UNION ALL SELECT * FROM {corpus_sql('doc_id % 3 = 0', 1)}) ORDER BY rank, corpus LIMIT 20")
def laws_searched(spark, sf_dir):
    """Two bodies of texts, each ranked by its own frequencies, in turns."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("article_id"), "text", F.lit("ZH").alias("canton"))
    found = library.search_laws(d.where("article_id % 3 > 0"), d.where("article_id % 3 = 0"), "trash OR idiot OR dans")
    return found.select("doc", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query(f"WITH {WORDS}, {bm25_sql(['scum', 'loser'])} SELECT doc_id, round(score, 6) AS score, md5(text) AS text_md5 FROM b JOIN documents ON doc = doc_id ORDER BY score DESC, doc_id LIMIT 15")
def table_searched(spark, sf_dir):
    """Any table of texts, searched and joined with its own columns."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return library.search_table(d, "scum OR loser", {"text": 1.2}, "doc_id", 15).select("doc_id", F.round("score", 6).alias("score"), F.md5("text").alias("text_md5"))


@query(f"""{WITH}, n AS (SELECT decision_id, substring(regeste, 1, 200) AS note FROM decisions WHERE length(regeste) >= 50), l AS (SELECT DISTINCT 'd' || (doc_id + 3) AS s, 'd' || doc_id AS t FROM documents),
    pairs AS (SELECT s, t, note FROM l JOIN n ON n.decision_id = s WHERE t IN (SELECT decision_id FROM n)), w AS (SELECT 'd' || doc_id AS doc, {TOK} AS t FROM documents),
    q AS (SELECT DISTINCT s, unnest({TOK.replace("text", "substring(note, 1, 100)")}) AS term FROM pairs), z AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM w),
    tf AS (SELECT doc, term, count(*) * 1.2 AS f, any_value(dl) AS dl FROM (SELECT doc, len(t) AS dl, unnest(t) AS term FROM w) GROUP BY doc, term), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    sc AS (SELECT s, doc, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / avgdl))), 9) AS score FROM q JOIN tf USING (term) JOIN df USING (term), z GROUP BY s, doc),
    b AS (SELECT s, doc, row_number() OVER (PARTITION BY s ORDER BY score DESC, doc) AS rank FROM sc QUALIFY rank <= 10)
    SELECT count(*) AS pairs, count(rank) AS hits, round(count(rank) / count(*), 4) AS hit_rate, round(avg(coalesce(1 / rank, 0)), 4) AS mrr FROM pairs LEFT JOIN b ON b.s = pairs.s AND b.doc = pairs.t""")
def retrieval_checked(spark, sf_dir):
    """For all headnotes of citing decisions, whether the cited one is among the ten best by the words of the note."""
    d = decisions(spark, sf_dir)
    links = d.select(F.concat(F.lit("d"), (F.col("doc_id") + 3).cast("string")).alias("source_decision_id"), F.col("decision_id").alias("target_decision_id"))
    return resolve.retrieval_check(indexed(spark, sf_dir), resolve.headnote_pairs(links, d), TEXT_ONLY)


@query("""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, unnest(range(len(string_split(text, chr(10))))) AS k FROM documents WHERE text IS NOT NULL)
    SELECT 'd' || doc_id AS decision_id, array_to_string(list_sort(list_distinct(flatten(list(['ART.' || (length(t) % 5 + 1) || '.OR', 'ART.' || (k % 3 + 1) || '.ZGB'])))), ';') AS statutes,
        md5(string_agg(substring(t, 1, CASE WHEN k = 0 THEN 1000 ELSE 500 END), '|' ORDER BY k)) AS excerpts_md5 FROM p GROUP BY doc_id""")
def briefs_compared(spark, sf_dir):
    """Of all paragraphs of each text the statutes, each once, and the beginnings."""
    p = table(spark, sf_dir, "documents").where("text IS NOT NULL").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("decision_id"), F.posexplode(F.split("text", "\n")).alias("position", "text"))
    statutes = F.array(F.concat(F.lit("ART."), (F.length("text") % 5 + 1).cast("string"), F.lit(".OR")), F.concat(F.lit("ART."), (F.col("position") % 3 + 1).cast("string"), F.lit(".ZGB")))
    found = library.brief_statutes(p.withColumn("statutes", statutes))
    return found.select("decision_id", F.array_join("statutes", ";").alias("statutes"), F.md5(F.array_join("excerpts", "|")).alias("excerpts_md5"))
