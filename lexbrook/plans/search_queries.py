"""Full-text and vector retrieval over documents and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import structure
from ..functions.text import tokens
from ..operators import compounds, search, sparseindex, vectorindex, vectors
from ..operators.index import index_for
from ..operators.lineage import shared_folder, stored
from .base import decisions
from .registry import query, table

TOK = r"[x for x in regexp_split_to_array(strip_accents(lower(text)), '[^\p{L}\p{N}]+') if x <> '']"
WORDS = f"w AS (SELECT doc_id AS doc, {TOK} AS t FROM documents)"


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("decision_id"), F.col("text").alias("full_text"))


def indexed(spark, sf_dir):
    """The index of the decisions, made once an application. Its documents are those of the table, under the ids of decisions."""
    d = decisions(spark, sf_dir)
    return index_for(spark, f"decisions of {sf_dir}", lambda: d, [f for f in search.FIELD_WEIGHTS if f in d.columns], keep=[f for f in (*search.FIELD_WEIGHTS, "decision_date") if f in d.columns])


def vector_index(spark, sf_dir):
    """The index of the embeddings, made once an application."""
    made = lambda: vectorindex.VectorIndex.write(table(spark, sf_dir, "embeddings"), folder).cells
    folder = f"{shared_folder(spark)}/vectors-{abs(hash((spark.sparkContext.applicationId, sf_dir))):x}"
    stored(spark, f"cells of the embeddings of {sf_dir}", made)
    return vectorindex.VectorIndex.open(spark, folder)


def of_documents(found):
    """Decisions' ids as those of the documents."""
    return found.withColumn("doc", F.substring("doc", 2, 20).cast("long"))


TEXT_ONLY = {"full_text": 1.2}


def bm25_sql(terms: list[str], name: str = "b") -> str:
    counts = ", ".join(f"1.2 * len([x for x in t if x = '{w}']) AS f{i}" for i, w in enumerate(terms))
    stats = ", ".join(f"count(CASE WHEN f{i} > 0 THEN 1 END) AS d{i}" for i in range(len(terms)))
    parts = " + ".join(f"CASE WHEN f{i} > 0 THEN ln(1 + (n - d{i} + 0.5) / (d{i} + 0.5)) * f{i} * 2.2 / (f{i} + 1.2 * (0.25 + 0.75 * dl / avgdl)) ELSE 0 END" for i in range(len(terms)))
    hit = " OR ".join(f"f{i} > 0" for i in range(len(terms)))
    return f"{name}c AS (SELECT doc, len(t) AS dl, {counts} FROM w), {name}s AS (SELECT count(*) AS n, avg(dl) AS avgdl, {stats} FROM {name}c), {name} AS (SELECT doc, {parts} AS score FROM {name}c, {name}s WHERE {hit})"


@query(rf"WITH {WORDS}, e AS (SELECT doc, unnest(t) AS term FROM w) SELECT term, count(DISTINCT doc) AS df, count(*) AS cf FROM e GROUP BY term")
def postings_df(spark, sf_dir):
    index = indexed(spark, sf_dir).rows.where("field = 'full_text'")
    return index.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


@query(f"WITH {WORDS}, {bm25_sql(['trash', 'idiot', 'dans', 'mentre'])} SELECT doc, round(score, 6) AS score FROM b ORDER BY score DESC, doc LIMIT 20")
def bm25_topk(spark, sf_dir):
    hits = of_documents(search.bm25(indexed(spark, sf_dir), ["trash", "idiot", "dans", "mentre"], TEXT_ONLY))
    return hits.select("doc", F.round("score", 6).alias("score")).orderBy(F.desc("score"), "doc").limit(20)


@query(f"WITH {WORDS}, {bm25_sql(['scum', 'loser'], 'qa')}, {bm25_sql(['der', 'nicht'], 'qb')} SELECT 0 AS query_id, doc, round(score, 6) AS score FROM qa UNION ALL SELECT 1, doc, round(score, 6) FROM qb")
def bm25_batch(spark, sf_dir):
    queries = spark.createDataFrame([(0, "scum"), (0, "loser"), (1, "der"), (1, "nicht")], "query_id int, term string")
    return of_documents(search.bm25_batch(indexed(spark, sf_dir), queries, TEXT_ONLY)).select("query_id", "doc", F.round("score", 6).alias("score"))


HAS = lambda w: f"list_contains(t, '{w}')"


@query(
    f"""WITH {WORDS} SELECT doc FROM w WHERE ({HAS('the')} OR {HAS('der')}) AND ' ' || array_to_string(t, ' ') || ' ' LIKE '% of the %' AND NOT {HAS('loser')} AND len([x for x in t if starts_with(x, 'thn')]) > 0"""
)
def boolean_search(spark, sf_dir):
    q = search.parse('(the OR der) "of the" thn* NOT loser')
    return of_documents(search.run(indexed(spark, sf_dir), [("", q)], TEXT_ONLY)).select("doc")


@query(
    f"""WITH {WORDS}, {bm25_sql(['trash', 'clown'])} SELECT doc, round(score, 6) AS score FROM b JOIN w USING (doc) WHERE {HAS('trash')} AND {HAS('clown')} ORDER BY round(score, 6) DESC, doc LIMIT 10 OFFSET 2"""
)
def search_paged(spark, sf_dir):
    hits = of_documents(search.search(decisions(spark, sf_dir), "trash AND clown", TEXT_ONLY, limit=None, index=indexed(spark, sf_dir)))
    return hits.select("doc", F.round("score", 6).alias("score")).orderBy(F.desc("score"), "doc").offset(2).limit(10)


@query(
    f"""WITH {WORDS}, {bm25_sql(['scum', 'loser'], 'qa')}, {bm25_sql(['pathetic'], 'qb')},
    r AS (SELECT 'one' AS s, 1.3 AS w, doc, row_number() OVER (ORDER BY round(score, 9) DESC, doc) AS k FROM qa UNION ALL SELECT 'two', 0.85, doc, row_number() OVER (ORDER BY round(score, 9) DESC, doc) FROM qb)
    SELECT doc, round(sum(w / (60 + k)), 9) AS rrf, count(DISTINCT s) AS hits FROM r GROUP BY doc"""
)
def rrf_fusion(spark, sf_dir):
    index = indexed(spark, sf_dir)
    runs = [(("scum", "loser"), "one", 1.3), (("pathetic",), "two", 0.85)]
    ranked = [search.ranked(of_documents(search.bm25(index, list(t), TEXT_ONLY)).withColumn("score", F.round("score", 9))).select("doc", "rank", F.lit(n).alias("strategy"), F.lit(w).alias("weight")) for t, n, w in runs]
    return search.fuse(ranked[0].unionByName(ranked[1])).select("doc", F.round("rrf", 9).alias("rrf"), "hits")


@query(
    f"""WITH {WORDS}, {bm25_sql(['trash', 'clown'])}, r AS (SELECT doc, score, row_number() OVER (ORDER BY round(score, 9) DESC, doc) AS k FROM b),
    c AS (SELECT doc, score, 1.3 / (60 + k) AS rrf, substring(d.text, 1, 200) AS snippet, substring(d.text, 1, 60) AS title FROM r JOIN documents d ON d.doc_id = r.doc),
    y AS (SELECT *, [x for x in regexp_split_to_array(strip_accents(lower(title)), '[^\\p{{L}}\\p{{N}}]+') if x <> ''] AS tt, [x for x in regexp_split_to_array(strip_accents(lower(snippet)), '[^\\p{{L}}\\p{{N}}]+') if x <> ''] AS ts FROM c)
    SELECT doc, round(score + 32 * rrf + 0.18 + 3.0 * ((CASE WHEN list_contains(tt, 'trash') THEN 1.0 ELSE 0 END) + (CASE WHEN list_contains(tt, 'clown') THEN 1.0 ELSE 0 END)) / 2
        + 0.8 * ((CASE WHEN list_contains(ts, 'trash') THEN 1.0 ELSE 0 END) + (CASE WHEN list_contains(ts, 'clown') THEN 1.0 ELSE 0 END)) / 2
        + CASE WHEN ' ' || array_to_string(tt, ' ') || ' ' || array_to_string(ts, ' ') || ' ' LIKE '% trash clown %' THEN 1.8 ELSE 0 END, 6) AS relevance_score FROM y"""
)
def composite_rerank(spark, sf_dir):
    d = documents(spark, sf_dir).select("decision_id", F.substring("full_text", 1, 200).alias("full_text"))  # no text beyond that is moved
    hits = search.ranked(of_documents(search.bm25(indexed(spark, sf_dir), ["trash", "clown"], TEXT_ONLY)).withColumn("key", F.round("score", 9)), "key")
    rows = hits.join(d, hits["doc"] == d["decision_id"]).select(
        "doc", F.col("score").alias("bm25"), (1.3 / (60 + F.col("rank"))).alias("rrf"), F.lit(1).alias("hits"), F.substring("full_text", 1, 200).alias("snippet"), F.substring("full_text", 1, 60).alias("title"),
        F.lit(None).cast("string").alias("regeste"), F.lit(None).cast("string").alias("docket_number"), F.lit(None).cast("string").alias("decision_date"),
    )
    return search.rerank(rows, "trash clown").select("doc", F.round("relevance_score", 6).alias("relevance_score"))


@query(
    """WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 50 = 0), s AS (SELECT query_id, vec_id AS id, list_cosine_similarity(embedding::DOUBLE[], e) AS sim FROM q, embeddings),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, id) AS rank FROM s) SELECT query_id, id, round(sim, 5) AS similarity, rank FROM r WHERE rank <= 10"""
)
def knn_cosine(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return vector_index(spark, sf_dir).search(q, 10, exact=True).select("query_id", "id", F.round("similarity", 5).alias("similarity"), F.col("rank").cast("long").alias("rank"))


@query("""WITH q AS (SELECT vec_id AS query_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 50 = 0), s AS (SELECT query_id, vec_id AS id, list_cosine_similarity(embedding::DOUBLE[], e) AS sim FROM q JOIN embeddings USING (label)),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, id) AS rank FROM s) SELECT query_id, id, round(sim, 5) AS similarity FROM r WHERE rank <= 5""")
def knn_in_partition(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"), "label")
    return vectors.nearest(e, q, 5, partition="label").select("query_id", "id", F.round("similarity", 5).alias("similarity"))


@query("""SELECT count(*) AS n_queries, 10 * count(*) AS n_pairs, true AS enough FROM embeddings WHERE vec_id % 50 = 0""")
def knn_recall(spark, sf_dir):
    """Of the ten nearest, the share that a search finds with as many cells as a sample asks for: nine in ten or more."""
    e = table(spark, sf_dir, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    index = vector_index(spark, sf_dir)
    r = vectorindex.recall(index.search(q, 10, probes=index.probes_for(10)), index.search(q, 10, exact=True))
    return r.select("n_queries", "n_pairs", (F.col("recall") >= 0.9).alias("enough"))


@query(
    """WITH t AS (SELECT vec_id AS id, unnest(embedding)::DOUBLE AS weight, unnest(range(len(embedding))) AS token_id FROM embeddings), s AS (SELECT * FROM t WHERE CAST(weight AS FLOAT) > 0.01),
    q AS (SELECT token_id, weight AS w FROM s WHERE id = 0) SELECT id, round(sum(weight * w), 6) AS score FROM s JOIN q USING (token_id) GROUP BY id ORDER BY score DESC, id LIMIT 20"""
)
def sparse_search(spark, sf_dir):
    terms = vectors.sparse_terms(table(spark, sf_dir, "embeddings"))
    query_terms = terms.where("id = 0").select("token_id", F.col("weight").alias("w"))
    return vectors.sparse_search(terms, query_terms, None).select("id", F.round("score", 6).alias("score")).orderBy(F.desc("score"), "id").limit(20)


@query(
    """WITH q AS (SELECT embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id = 7) SELECT vec_id % 40 AS doc, round(min(1 - list_cosine_similarity(embedding::DOUBLE[], e)), 5) AS distance FROM embeddings, q GROUP BY 1 ORDER BY distance, doc LIMIT 10"""
)
def chunk_knn(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").withColumn("doc_of", F.col("vec_id") % 40)
    q = e.where("vec_id = 7").first()["embedding"]
    return vectors.best_chunk(e, q, 40, "doc_of").select("doc", F.round("distance", 5).alias("distance")).orderBy("distance", "doc").limit(10)


@query(
    """WITH s AS (SELECT vec_id AS id, unnest(embedding) AS weight, unnest(range(len(embedding))) AS token_id FROM embeddings), t AS (SELECT id, token_id, weight::DOUBLE AS weight FROM s WHERE weight > 0.01),
    q AS (SELECT id AS query_id, token_id, weight AS w FROM t WHERE id % 50 = 0), p AS (SELECT query_id, t.id, sum(w * weight) AS score FROM q JOIN t USING (token_id) GROUP BY ALL)
    SELECT query_id, id, round(score, 6) AS score FROM p QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= 10"""
)
def sparse_topk(spark, sf_dir):
    """The ten best sparse vectors of each query, from blocks by impact."""
    terms = vectors.sparse_terms(table(spark, sf_dir, "embeddings"))
    index = sparseindex.SparseIndex.build(terms)
    found, _ = index.search(terms.where("id % 50 = 0").select(F.col("id").alias("query_id"), "token_id", F.col("weight").alias("w")), 10)
    return found.select("query_id", "id", F.round("score", 6).alias("score"))


QUESTION = "Je cherche un arrêt sur that this with than ther inthe"
ASKED = ["that", "this", "with", "than", "ther", "inthe"]


@query(
    f"""WITH {WORDS}, d AS (SELECT DISTINCT doc, unnest(t) AS term FROM w), n AS (SELECT term, count(*) AS df FROM d WHERE term IN {tuple(ASKED)} GROUP BY term),
    a AS (SELECT term, row_number() OVER (ORDER BY df, list_position({ASKED}, term)) AS o FROM n),
    c AS (SELECT term, df, row_number() OVER (ORDER BY list_position({ASKED}, term)) AS i FROM n),
    p AS (SELECT x.term AS a, y.term AS b, row_number() OVER (ORDER BY x.df * y.df, x.i) AS o FROM c x JOIN c y ON y.i = x.i + 1)
    SELECT 'anchor_pair_' || a || '_' || b AS name, x.doc FROM p JOIN d x ON x.term = a JOIN d y ON y.term = b AND y.doc = x.doc WHERE o <= 3
    UNION ALL SELECT 'anchor_' || term, doc FROM a JOIN d USING (term) WHERE o <= 2
    UNION ALL SELECT 'lang_fr_and', doc_id FROM documents WHERE lang = 'fr' AND (SELECT count(*) FROM d WHERE doc = doc_id AND term IN {tuple(ASKED)}) = {len(ASKED)}"""
)
def anchored(spark, sf_dir):
    """What a question's anchors, pairs of anchors and language find: strategies chosen by the index's frequencies."""
    index, fields = indexed(spark, sf_dir), {"full_text": 1.2, "language": 0.8}
    ws = search.content_words(QUESTION)
    runs = search.strategies(QUESTION, frequencies=index.frequencies(ws, ["full_text"]), docs=index.docs, fields=fields)
    runs = [(name, search.parse(q)) for name, q, _ in runs if name.startswith(("anchor_", "lang_"))]
    return of_documents(search.run(index, runs, fields)).select("name", "doc")


TERMS = f"WITH {WORDS} SELECT term, count(*) AS df FROM (SELECT DISTINCT doc, unnest(t) AS term FROM w) GROUP BY term"


@query(compounds.oracle(TERMS))
def compounds_split(spark, sf_dir):
    """All words of the documents that are made of others."""
    d = documents(spark, sf_dir)
    terms = d.select(F.explode(F.array_distinct(tokens("full_text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return compounds.splits(terms).select("term", F.array_join("parts", "+").alias("parts"))


HEADING = structure.SECTION.removeprefix("(?dimuU)")
TRIMMED = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


@query(
    rf"""WITH d AS (SELECT 'd' || doc_id AS decision_id, text AS t FROM documents WHERE text <> ''),
    s AS (SELECT *, string_split(regexp_replace(t, '(?im){HEADING}', chr(1) || '\0', 'g'), chr(1)) AS raw, [x for x in list_transform(regexp_split_to_array(t, '\n\s*\n'), lambda x: {TRIMMED.format("x")}) if x <> ''] AS ps FROM d),
    k AS (SELECT *, list_filter(list_transform(range(1, len(raw) + 1), lambda i: CASE WHEN (i = 1 AND length(raw[i]) > 50) OR (i > 1 AND length({TRIMMED.format("raw[i]")}) >= 50) THEN {TRIMMED.format("raw[i]")} END), lambda x: x IS NOT NULL) AS sec,
        list_transform(range(1, len(ps) + 1), lambda i: list_sum(list_transform(ps[1:i], lambda x: length(x)))) AS c FROM s),
    b AS (SELECT *, list_min(list_filter(range(1, len(ps)), lambda i: c[i] >= c[len(ps)] // 3)) AS s1 FROM k),
    e AS (SELECT *, list_min(list_filter(range(1, len(ps)), lambda i: i > s1 AND c[i] - c[s1] >= c[len(ps)] // 3)) AS s2 FROM b),
    p AS (SELECT *, CASE WHEN len(ps) <= 3 THEN ps WHEN s1 IS NULL THEN [array_to_string(ps, chr(10) || chr(10))] WHEN s2 IS NULL THEN [array_to_string(ps[1:s1], chr(10) || chr(10)), array_to_string(ps[s1 + 1:len(ps)], chr(10) || chr(10))]
        ELSE [array_to_string(ps[1:s1], chr(10) || chr(10)), array_to_string(ps[s1 + 1:s2], chr(10) || chr(10)), array_to_string(ps[s2 + 1:len(ps)], chr(10) || chr(10))] END AS runs FROM e),
    f AS (SELECT decision_id, CASE WHEN length(t) < 100 THEN [t] WHEN len(raw) > 1 AND len(sec) > 1 THEN sec[1:3] WHEN len(runs) > 1 THEN runs ELSE [t, substring(t, length(t) // 3 + 1, 500), substring(t, 2 * length(t) // 3 + 1, 500)] END AS cs FROM p)
    SELECT decision_id, unnest(range(len(cs))) AS position, unnest(list_transform(cs, lambda x: substring(x, 1, 500))) AS chunk FROM f"""
)
def chunk_explode(spark, sf_dir):
    return structure.chunk_table(decisions(spark, sf_dir))


@query()
def structure_paragraphs(spark, sf_dir):
    d = decisions(spark, sf_dir)
    # the whole text, dealt out over three numbered paragraphs
    third = F.ceil(F.length("full_text") / 3).cast("int")
    first, second, last = (F.col("full_text").substr(k * third + 1, third) for k in (F.lit(0), F.lit(1), F.lit(2)))
    body = F.concat(F.lit("Sachverhalt\nA. Der Kläger\nErwägungen:\n1. "), first, F.lit("\n1.1 "), second, F.lit("\n2. "), last, F.lit("\nDemnach erkennt das Bundesgericht:\n1. Abgewiesen.\n2. Kosten.\nLausanne"))
    return structure.paragraph_table(d.select("decision_id", body.alias("full_text"), F.lit("de").alias("language")))


@query()
def find_decisions(spark, sf_dir):
    """The flagship: strategies, BM25, fusion, signals and passages for a query in natural language."""
    return search.find(decisions(spark, sf_dir), "trash clown worthless", limit=20, language="en", index=indexed(spark, sf_dir))
