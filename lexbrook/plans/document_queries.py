"""Documents that come in other shapes, as tables: nested laws, volumes of pages, compilations, services with pages."""

from __future__ import annotations



from pyspark.sql import functions as F

from ..functions import structure
from ..operators import lawtrees, volumes
from ..operators.volumes import BACK_MATTER
from ..sources import paged
from ..streaming import state
from .registry import query, table
from .source_queries import place


def law_trees(spark, sf_dir):
    """Laws of ten documents each: titles by language, articles, paragraphs and enumerations by lines of the text; a footnote in each article."""
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.floor(F.col("doc_id") / 10).alias("law_id"), F.coalesce("lang", F.lit("")).alias("lang"), F.split("text", "\n").alias("lines"))
    coded = F.transform("lines", lambda x: F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")))
    d = d.withColumn("lines", coded)

    def leaf(kind, x):
        return F.struct(F.lit(kind).alias("type"), F.struct(F.concat(F.lit("<p><span class='text_content'>"), x, F.lit("</span></p>")).alias("de")).alias("html_content"))

    first = F.transform(F.slice("lines", 1, 1), lambda x: F.struct(F.lit("paragraph").alias("type"), F.struct(x.alias("de")).alias("html_content"), F.transform(F.slice("lines", 2, 1_000_000), lambda y: leaf("enumeration", y)).alias("children")))
    note = F.array(F.struct(F.lit("footnote").alias("type"), F.struct(F.lit("Fussnote").alias("de")).alias("html_content"), F.array(leaf("enumeration", F.lit("auch nicht"))).alias("children")))
    article = F.struct(
        F.lit("article").alias("type"), F.struct(F.concat(F.lit("§&nbsp;"), "doc_id").alias("de")).alias("number"), F.struct(F.concat(F.lit("Titel "), "doc_id").alias("de")).alias("text"), F.concat(first, note).alias("children")
    )
    titles = d.groupBy("law_id", "lang").agg(F.array_sort(F.collect_list(F.struct("doc_id", article.alias("a")))).alias("x"))
    title = F.struct(F.lit("title").alias("type"), F.struct(F.lit("I.").alias("de")).alias("number"), F.struct(F.col("lang").alias("de")).alias("text"), F.col("x.a").alias("children"))
    laws = titles.groupBy("law_id").agg(F.array_sort(F.collect_list(F.struct("lang", title.alias("t")))).alias("x"))
    return laws.select("law_id", F.to_json(F.struct(F.lit("document").alias("type"), F.col("x.t").alias("children"))).alias("tree"))


LINES = r"list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(regexp_replace(x, '[ \t]+', ' ', 'g'), '^\s+|\s+$', '', 'g')), lambda x: x <> '')"


@query(f"""SELECT doc_id // 10 AS law_id, doc_id::VARCHAR AS article_num, 'Titel ' || doc_id AS heading, 'I.' || CASE WHEN coalesce(lang, '') = '' THEN '' ELSE ' ' || lang END AS under, md5(array_to_string({LINES}, chr(10))) AS text_md5,
    row_number() OVER (PARTITION BY doc_id // 10 ORDER BY coalesce(lang, ''), doc_id) AS nth FROM documents WHERE text IS NOT NULL""")
def law_articles_walked(spark, sf_dir):
    """Articles of nested laws with the title above them, by opening trees level by level."""
    found = lawtrees.articles(lawtrees.nodes(law_trees(spark, sf_dir)))
    nth = F.row_number().over(lawtrees_order())
    return found.select("law_id", "article_num", "heading", "under", F.md5("text").alias("text_md5"), nth.cast("long").alias("nth"))


def lawtrees_order():
    from pyspark.sql import Window

    return Window.partitionBy("law_id").orderBy("place")


@query(f"""WITH a AS (SELECT doc_id // 10 AS law_id, coalesce(lang, '') AS lang, doc_id, 'Art. ' || doc_id || ' Titel ' || doc_id AS head, array_to_string({LINES}, chr(10)) AS body FROM documents WHERE text IS NOT NULL),
    p AS (SELECT law_id, lang, -1 AS doc_id, 0 AS k, 'I.' || CASE WHEN lang = '' THEN '' ELSE ' ' || lang END AS line FROM (SELECT DISTINCT law_id, lang FROM a)
        UNION ALL SELECT law_id, lang, doc_id, 1, head FROM a UNION ALL SELECT law_id, lang, doc_id, 2, body FROM a WHERE body <> '')
    SELECT law_id, md5(string_agg(line, chr(10) || chr(10) ORDER BY lang, doc_id, k)) AS text_md5 FROM p GROUP BY law_id""")
def law_texts_walked(spark, sf_dir):
    return lawtrees.whole_texts(lawtrees.nodes(law_trees(spark, sf_dir))).select("law_id", F.md5("full_text").alias("text_md5"))


@query("""WITH d AS (SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[^A-Za-z]+', ' ', 'g'), '^ +| +$', '', 'g')) AS t FROM documents WHERE text IS NOT NULL)
    SELECT 'd' || doc_id AS decision_id, CASE WHEN doc_id % 4 < 2 THEN md5('A. ' || t) END AS facts_md5, doc_id % 4 = 3 AS is_excerpt,
        CASE doc_id % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.6 WHEN 2 THEN 0.7 ELSE 0.9 END AS parse_quality, CASE WHEN doc_id % 4 IN (0, 2, 3) THEN md5('Rn ' || t) END AS second_md5 FROM d WHERE t <> ''""")
def study_parsed(spark, sf_dir):
    """Decisions made of whole texts: whole ones, ones without numbers or without facts, excerpts."""
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.trim(F.regexp_replace("text", "[^A-Za-z]+", " ")).alias("t")).where("t <> ''")
    k = F.col("doc_id") % 4
    facts, end = F.concat(F.lit("\nSachverhalt\n\nA. "), "t", F.lit("\n")), F.lit("\nDemnach erkennt das Bundesgericht:\n\n1. Die Beschwerde wird abgewiesen.\n")
    numbered = F.concat(F.lit("\nErwägungen\n\n1. Erstens.\n\n2. Rn "), "t", F.lit("\n"))
    plain = F.concat(F.lit("\nErwägungen\n\nRn "), "t", F.lit("\n"))
    body = F.when(k == 0, F.concat(facts, numbered, end)).when(k == 1, F.concat(facts, plain)).when(k == 2, F.concat(numbered, end)).otherwise(F.concat(F.lit("Aus den Erwägungen:\n"), numbered, end))
    rows = d.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("decision_id"), body.alias("full_text"), F.lit("de").alias("language"))
    second = F.filter("paragraphs", lambda p: p["e_number"] == "2")
    text = F.regexp_replace(F.get(second, F.lit(0))["text"], r"^\s*2\.\s*|\s+$", "")
    return structure.study_table(rows).select("decision_id", F.md5("sachverhalt").alias("facts_md5"), "is_excerpt", "parse_quality", F.md5(text).alias("second_md5"))


#: Pages of 40 documents a volume: a table of contents, headers on most pages, some with an older number or in old print, an index at the end.
PAGES = """SELECT CAST(floor(doc_id / 40) AS BIGINT) AS volume, doc_id % 40 AS page, concat(CASE WHEN doc_id % 40 = 0 THEN concat('Inhalt', chr(10), 'Nr. 9', chr(10))
    WHEN doc_id % 40 = 38 THEN concat('Sachregister', chr(10)) WHEN doc_id % 7 = 3 THEN '' WHEN doc_id % 40 > 9 AND doc_id % 11 = 5 THEN concat('vgl. Nr. 2', chr(10))
    WHEN doc_id % 40 < 4 THEN concat('MKGE No. l', chr(10)) ELSE concat('MKGE Nr. ', CAST(CAST(floor((doc_id % 40) / 3) AS BIGINT) AS STRING), chr(10)) END, text) AS text FROM {documents} WHERE text IS NOT NULL"""
SQL_BACK = BACK_MATTER.removeprefix("(?iuU)").replace("'", "''")


@query(f"""WITH p AS ({PAGES.replace("{documents}", "documents")}),
    l AS (SELECT volume, page, text, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS ls FROM p),
    t AS (SELECT volume, page, text, unnest(list_concat(regexp_extract_all(array_to_string(ls[1:6], chr(10)), '\\b(?:Nr|No)\\.?\\s*([0-9lIO]{{1,3}})\\b', 1), regexp_extract_all(array_to_string(ls[-6:], chr(10)), '\\b(?:Nr|No)\\.?\\s*([0-9lIO]{{1,3}})\\b', 1))) AS x FROM l),
    c AS (SELECT volume, page, translate(x, 'lIO', '110') AS x FROM t), n AS (SELECT volume, page, x::INT AS nr, count(*) AS k FROM c WHERE regexp_matches(x, '^[1-9]') AND x::INT <= 200 GROUP BY ALL),
    h AS (SELECT volume, page, nr FROM n QUALIFY row_number() OVER (PARTITION BY volume, page ORDER BY k DESC, nr) = 1),
    r AS (SELECT p.*, nr, lag(nr) OVER (PARTITION BY volume ORDER BY page) AS before FROM p LEFT JOIN h USING (volume, page)),
    s AS (SELECT *, min(page) FILTER (nr = 1 OR nr = before) OVER (PARTITION BY volume) AS start FROM r),
    e AS (SELECT *, min(page) FILTER (page > start AND regexp_matches(text, '(?i){SQL_BACK}')) OVER (PARTITION BY volume) AS stop FROM s),
    m AS (SELECT volume, page, text, max(nr) OVER (PARTITION BY volume ORDER BY page) AS number FROM e WHERE page >= start AND (stop IS NULL OR page < stop)),
    d AS (SELECT volume, number, min(page) AS first_page, count(*) AS n_pages, regexp_replace(string_agg(text, chr(10) ORDER BY page), '^\\s+|\\s+$', '', 'g') AS text FROM m WHERE number IS NOT NULL GROUP BY volume, number)
    SELECT volume, number, first_page, n_pages, md5(text) AS text_md5 FROM d WHERE length(text) >= 200""")
def volumes_cut(spark, sf_dir):
    """Decisions of volumes of pages, each of which is a whole document under a header."""
    pages = spark.sql(PAGES, documents=table(spark, sf_dir, "documents"))
    return volumes.decisions_of_volumes(pages).select("volume", "number", "first_page", F.col("n_pages").cast("long").alias("n_pages"), F.md5("text").alias("text_md5"))


@query("""WITH d AS (SELECT doc_id // 20 AS compilation, doc_id % 20 AS n, text FROM documents WHERE text IS NOT NULL AND doc_id % 20 > 1),
    k AS (SELECT compilation, n // 3 AS number, regexp_replace(string_agg(n || ' - 20' || chr(10) || text, chr(10) || chr(10) ORDER BY n), '^\\s+|\\s+$', '', 'g') AS text FROM d GROUP BY 1, 2)
    SELECT compilation, number, 'Titel ' || number AS title, md5(regexp_replace(text, '\\n\\d+\\s*-\\s*\\d+\\s*\\n', chr(10), 'g')) AS text_md5 FROM k WHERE length(regexp_replace(text, '\\n\\d+\\s*-\\s*\\d+\\s*\\n', chr(10), 'g')) >= 200""")
def compilations_cut(spark, sf_dir):
    """Decisions of compilations, by a table of contents on the first page that names the pages where they begin."""
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL").select(F.floor(F.col("doc_id") / 20).alias("compilation"), (F.col("doc_id") % 20).alias("n"), "text")
    body = d.where("n > 1").select("compilation", F.col("n").alias("page"), F.concat(F.col("n").cast("string"), F.lit(" - 20\n"), F.col("text")).alias("text"))
    starts = d.where("n > 1").groupBy("compilation", F.floor(F.col("n") / 3).alias("number")).agg(F.min("n").alias("start"))
    entry = F.format_string("%d.\nTitel %d ........ %d\n", "number", "number", "start")
    toc = starts.groupBy("compilation").agg(F.array_join(F.array_sort(F.collect_list(F.struct("number", entry.alias("e"))))["e"], "").alias("text"))
    front = toc.select("compilation", F.lit(0).cast("long").alias("page"), "text").unionByName(toc.select("compilation", F.lit(1).cast("long").alias("page"), F.lit("Vorwort").alias("text")))
    found = volumes.decisions_of_compilations(body.unionByName(front))
    return found.select("compilation", F.col("number").cast("long").alias("number"), "title", F.md5("text").alias("text_md5"))


@query("SELECT 'l' || coalesce(lang, '') AS key, doc_id AS id, md5(text) AS text_md5 FROM documents")
def pages_fetched(spark, sf_dir):
    """All documents from a service with pages: half of them by a first run, what was added by a second one that goes on from there."""
    folder, to, progress = (place(spark, x) for x in ("service", "fetched", "progress"))
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("l"), F.coalesce("lang", F.lit(""))).alias("key"), F.col("doc_id").alias("id"), F.col("text").alias("value"))
    half = F.xxhash64("id") % 2 == 0
    for k, now in enumerate((half, ~half)):
        d.where(now).withColumn("page", F.lit(k)).write.mode("append").partitionBy("key", "page").option("ignoreNullFields", False).json(folder)
        keys, fetch, count = paged.folder_of_pages(folder)
        source = paged.paged(fetch, keys(), "key string, id long, value string", count, size=200)
        state.run_to_folder(paged.load(spark, source, stream=True), to, progress).awaitTermination()
    return spark.read.parquet(to).select("key", "id", F.md5("value").alias("text_md5"))
