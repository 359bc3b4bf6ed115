"""Citation graph over derived decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph, search
from ..operators.lineage import stored
from .base import WITH, decisions
from .registry import query
from .search_queries import TEXT_ONLY, TOK, indexed
from .text_queries import NORM, A, B, C_, D_, E_

EDGES = f"""{WITH}, nodes AS (SELECT decision_id, court, canton, decision_date, {NORM} AS docket_norm FROM decisions),
edges AS (SELECT 'd' || doc_id AS src, 'BGE ' || {A} || ' III ' || {B} AS ref, 'bge' AS kind FROM documents
    UNION ALL SELECT 'd' || doc_id, '4A_' || {E_} || '_2019', 'docket' FROM documents
    UNION ALL SELECT 'd' || doc_id, {C_} || ' III ' || {D_}, 'docket' FROM documents)"""
ISO = r"'^\d{4}-\d{2}-\d{2}$'"


def confidence(ref: str | None, rank: str, count: str) -> str:
    days = f"CASE WHEN regexp_matches(s.decision_date, {ISO}) AND regexp_matches(t.decision_date, {ISO}) THEN datediff('day', CAST(t.decision_date AS DATE), CAST(s.decision_date AS DATE)) END"
    court = "0.0" if ref is None else rf"CASE WHEN regexp_matches({ref}, '^[1-9][A-Z]_\d') THEN CASE WHEN t.court = 'bger' THEN 0.20 ELSE -0.20 END ELSE 0.0 END"
    return f"""greatest(0.05, least(0.99, round(CAST(0.55 AS DOUBLE) + {court} + CASE WHEN s.canton = t.canton THEN 0.10 ELSE 0.0 END + CASE WHEN s.court = t.court THEN 0.08 ELSE 0.0 END
        + CASE WHEN ({days}) >= 0 THEN 0.15 WHEN ({days}) < 0 THEN -0.15 ELSE 0.0 END + CASE WHEN abs({days}) <= 365 THEN 0.10 WHEN abs({days}) <= 1095 THEN 0.05 ELSE 0.0 END
        + CASE {rank} WHEN 1 THEN 0.05 WHEN 2 THEN 0.02 ELSE 0.0 END - CASE WHEN {count} > 1 THEN least(0.15, 0.03 * ({count} - 1)) ELSE 0.0 END, 4)))"""


TARGETS = f"""{EDGES}, c1 AS (SELECT e.src, e.ref, t.decision_id AS tgt, row_number() OVER (PARTITION BY e.src, e.ref ORDER BY t.decision_date DESC NULLS LAST, t.decision_id) AS rk, count(*) OVER (PARTITION BY e.src, e.ref) AS cn
    FROM edges e JOIN nodes t ON t.docket_norm = e.ref WHERE e.kind = 'docket' AND t.decision_id <> e.src),
p1 AS (SELECT c1.src, c1.ref, c1.tgt, 'docket_norm' AS match_type, {confidence("c1.ref", "rk", "cn")} AS conf FROM c1 JOIN nodes s ON s.decision_id = c1.src JOIN nodes t ON t.decision_id = c1.tgt),
p2 AS (SELECT e.src, e.ref, t.decision_id AS tgt, 'bge_norm' AS match_type, {confidence(None, "1", "1")} AS conf FROM edges e JOIN nodes s ON s.decision_id = e.src
    JOIN nodes t ON (t.docket_norm = e.ref OR t.docket_norm = substring(e.ref, 5)) AND t.court IN ('bge', 'bger', 'bge_historical') WHERE e.kind = 'bge' AND t.decision_id <> e.src),
p3 AS (SELECT e.src, e.ref, t.decision_id AS tgt, 'bge_bare' AS match_type, {confidence(None, "1", "1")} AS conf FROM edges e JOIN nodes s ON s.decision_id = e.src
    JOIN nodes t ON t.docket_norm = 'BGE ' || e.ref AND t.court IN ('bge', 'bger', 'bge_historical')
    WHERE e.kind = 'docket' AND e.ref LIKE '% III %' AND t.decision_id <> e.src AND NOT EXISTS (SELECT 1 FROM p1 WHERE p1.src = e.src AND p1.ref = e.ref)),
targets AS (SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3)"""


def built(spark, sf_dir):
    """Decisions, citations and what they resolve to; texts are searched once an application, not once a query."""
    d = decisions(spark, sf_dir)
    edges = stored(spark, f"citations of {sf_dir}", lambda: graph.citation_edges(d, F.col("refs")))
    return d, edges, graph.Links.of(edges, graph.vertices(d))


@query("SELECT 'd' || doc_id AS decision_id, unnest(['ART.' || (doc_id % 50 + 1) || '.ABS.' || (doc_id % 4 + 1) || '.OR', 'ART.' || (doc_id % 30 + 1) || '.ZGB']) AS statute_id, 1 AS mention_count FROM documents")
def statute_edges(spark, sf_dir):
    return graph.statute_edges(decisions(spark, sf_dir), F.col("refs"))


@query(f"{EDGES} SELECT src AS source_decision_id, ref AS target_ref, kind AS target_type, 1 AS mention_count, 0 AS is_prior FROM edges")
def citation_edges(spark, sf_dir):
    return graph.citation_edges(decisions(spark, sf_dir), F.col("refs"))


@query(f"""{EDGES}, pr AS (SELECT src, ref FROM edges WHERE kind = 'docket' AND CAST(substring(src, 2) AS BIGINT) % 10 = 0 UNION ALL SELECT 'd' || doc_id, '9Z_' || doc_id || '/1999' FROM documents WHERE doc_id % 10 = 5)
    SELECT coalesce(e.src, pr.src) AS source_decision_id, coalesce(e.ref, pr.ref) AS target_ref, coalesce(e.kind, 'docket') AS target_type, 1 AS mention_count, CASE WHEN pr.src IS NULL THEN 0 ELSE 1 END AS is_prior
    FROM edges e FULL JOIN pr ON pr.src = e.src AND pr.ref = e.ref""")
def prior_edges(spark, sf_dir):
    """Citations and earlier instances together: an earlier instance that is cited as well counts once, one that is not is an edge of its own."""
    d = decisions(spark, sf_dir)
    cited = graph.citation_edges(d, F.col("refs")).where("target_type = 'docket'").where(F.substring("source_decision_id", 2, 20).cast("long") % 10 == 0).select("source_decision_id", "target_ref")
    more = d.where("doc_id % 10 = 5").select(F.col("decision_id").alias("source_decision_id"), F.concat(F.lit("9Z_"), F.col("doc_id").cast("string"), F.lit("/1999")).alias("target_ref"))
    return graph.citation_edges(d, F.col("refs"), prior=cited.unionByName(more))


#: Whole texts with their references behind them, parsed by both sides.
BODIES = f"{WITH}, t AS (SELECT decision_id, full_text || chr(10) || refs AS b FROM decisions)"
REPORT, DOCKET1, DOCKET2, BARE = r"\bBGE\s+\d{1,3}\s+[IVX]{1,4}\s+\d{1,4}\b", r"\b[A-Z0-9]{1,4}[._-]\d{1,6}[/_]\d{4}\b", r"\b[A-Z]{1,6}\.\d{4}\.\d{1,6}\b", r"\b\d{1,3}\s+[IVX]{1,4}\s+\d{1,4}\b"


@query(rf"""{BODIES}, c AS (SELECT decision_id, 'bge' AS kind, unnest(regexp_extract_all(b, '(?i){REPORT}')) AS raw FROM t UNION ALL SELECT decision_id, 'docket', unnest(regexp_extract_all(b, '{DOCKET1}') || regexp_extract_all(b, '{DOCKET2}') || regexp_extract_all(regexp_replace(b, '(?i){REPORT}', ' | ', 'g'), '{BARE}')) FROM t),
    n AS (SELECT decision_id, kind, CASE WHEN kind = 'bge' OR regexp_matches(raw, '^{BARE}$') THEN regexp_replace(upper(raw), '\s+', ' ', 'g') ELSE regexp_replace(regexp_replace(translate(upper(raw), '-./', '___'), '_+', '_', 'g'), '^_+|_+$', '', 'g') END AS ref FROM c)
    SELECT decision_id AS source_decision_id, ref AS target_ref, min(kind) AS target_type FROM n GROUP BY 1, 2""")
def citations_of_whole_texts(spark, sf_dir):
    body = F.concat_ws("\n", "full_text", "refs")
    return graph.citation_edges(decisions(spark, sf_dir), body).select("source_decision_id", "target_ref", "target_type")


@query(rf"""{BODIES}, m AS (SELECT decision_id, unnest(regexp_extract_all(b, '\b(?i:art(?:ikel|icle|icolo)?\.?)\s*\d+\s*(?:Abs\.\s*\d+\s*)?[A-Z][A-Z0-9]{{1,11}}\b')) AS raw FROM t)
    SELECT DISTINCT decision_id, 'ART.' || regexp_extract(raw, '(?i)art[a-z.]*\s*(\d+)', 1) || CASE WHEN raw LIKE '%Abs.%' THEN '.ABS.' || regexp_extract(raw, 'Abs\.\s*(\d+)', 1) ELSE '' END || '.' || regexp_extract(raw, '([A-Z][A-Z0-9]{{1,11}})$', 1) AS statute_id FROM m""")
def statutes_of_whole_texts(spark, sf_dir):
    return graph.statute_edges(decisions(spark, sf_dir), F.concat_ws("\n", "full_text", "refs")).select("decision_id", "statute_id")


@query(f"{TARGETS} SELECT src AS source_decision_id, ref AS target_ref, tgt AS target_decision_id, match_type, conf AS confidence_score FROM targets")
def confidence_score(spark, sf_dir):
    return built(spark, sf_dir)[2].pairs()


@query(f"{TARGETS} SELECT src AS source_decision_id, ref AS target_ref, tgt AS target_decision_id FROM p2")
def or_join_exploded(spark, sf_dir):
    links = built(spark, sf_dir)[2]
    return graph.Links(links.refs.where("kind = 1"), links.candidates).pairs().select("source_decision_id", "target_ref", "target_decision_id")


@query(f"{TARGETS} SELECT count(*) AS refs, count(h) AS resolved, round(count(h) / count(*), 4) AS rate FROM edges e LEFT JOIN (SELECT DISTINCT src, ref, 1 AS h FROM targets) t ON t.src = e.src AND t.ref = e.ref")
def resolution_rate(spark, sf_dir):
    _, edges, links = built(spark, sf_dir)
    return graph.resolution_rate(edges, links)


@query(f"""{TARGETS} SELECT (SELECT count(*) FROM edges) AS citations, (SELECT count(DISTINCT src) FROM edges) AS citing, count(*) AS links, count(DISTINCT src || '|' || ref) AS resolved, count(DISTINCT tgt) AS cited FROM targets""")
def graph_stats(spark, sf_dir):
    _, edges, links = built(spark, sf_dir)
    return graph.graph_stats(edges, links)


@query(
    f"""{TARGETS}, m AS (SELECT 'd' || doc_id AS id, 1 AS mentions FROM documents WHERE doc_id % 30 + 1 = 7), c AS (SELECT tgt, count(DISTINCT src) AS citations FROM targets GROUP BY tgt)
    SELECT id AS decision_id, CAST(mentions AS BIGINT) AS mentions, coalesce(citations, 0) AS citations FROM m LEFT JOIN c ON c.tgt = m.id ORDER BY citations DESC, mentions DESC, decision_id LIMIT 8"""
)
def leading_cases(spark, sf_dir):
    d, _, links = built(spark, sf_dir)
    return graph.leading_cases(graph.statute_edges(d, F.col("refs")), links, "ART.7.ZGB")


@query(f"{TARGETS} SELECT tgt AS decision_id, round(least(1.0, 0.03 * sum(conf)), 6) AS authority FROM targets GROUP BY tgt")
def authority(spark, sf_dir):
    return graph.authority(built(spark, sf_dir)[2]).select("decision_id", F.round("authority", 6).alias("authority"))


@query(
    f"""{TARGETS} SELECT 'outgoing' AS direction, tgt AS other, e.ref AS target_ref FROM edges e LEFT JOIN (SELECT * FROM targets WHERE conf >= 0.3) t ON t.src = e.src AND t.ref = e.ref WHERE e.src = 'd5'
    UNION ALL SELECT 'incoming', src, ref FROM targets WHERE tgt = 'd5' AND conf >= 0.3"""
)
def citations_of(spark, sf_dir):
    _, edges, links = built(spark, sf_dir)
    return graph.citations_of(edges, links.about("d5"), "d5", limit=None).select("direction", "other", "target_ref")


INSTANCES = "SELECT doc_id AS a, doc_id - 1 AS b FROM documents WHERE doc_id % 16 <> 0 AND doc_id >= 1"


@query(
    f"""WITH RECURSIVE prior AS (SELECT 'd' || a AS a, 'd' || b AS b FROM ({INSTANCES})), linked AS (SELECT a AS s FROM prior UNION SELECT b FROM prior),
    up AS (SELECT s, s AS id, 0 AS k FROM linked UNION ALL SELECT up.s, prior.b, up.k - 1 FROM up JOIN prior ON prior.a = up.id),
    down AS (SELECT s, s AS id, 0 AS k FROM linked UNION ALL SELECT down.s, prior.a, down.k + 1 FROM down JOIN prior ON prior.b = down.id)
    SELECT s AS start, id AS decision_id, CAST(k AS INT) AS distance FROM up UNION SELECT s, id, CAST(k AS INT) FROM down"""
)
def appeal_chain_whole(spark, sf_dir):
    """The chain of every decision that has a link, to its ends; derived chains are 16 decisions long."""
    d = decisions(spark, sf_dir)
    prior = d.where("doc_id % 16 <> 0 AND doc_id >= 1").select("decision_id", F.concat(F.lit("d"), (F.col("doc_id") - 1).cast("string")).alias("prior_id"))
    linked = prior.select("decision_id").union(prior.select("prior_id")).distinct()
    return graph.appeal_chain(prior, linked)


@query(f"""{WITH}, w AS (SELECT doc_id, {TOK} AS t FROM documents) SELECT substring(decision_date, 1, 4) AS year, count(*) AS n FROM decisions JOIN w USING (doc_id)
    WHERE (list_contains(t, 'trash') OR list_contains(t, 'der')) AND regexp_matches(substring(decision_date, 1, 4), '^[0-9]{{4}}$') GROUP BY 1""")
def trend_of_search(spark, sf_dir):
    """Decisions by year that a search finds, all of them."""
    found = search.search(decisions(spark, sf_dir), "trash OR der", TEXT_ONLY, limit=None, index=indexed(spark, sf_dir))
    return graph.trend(decisions(spark, sf_dir), found.select(F.col("doc").alias("decision_id")))
