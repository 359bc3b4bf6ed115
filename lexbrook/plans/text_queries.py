"""Scalar functions and reference extraction over documents, pages and derived decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import references as R
from ..functions import text as X
from ..operators import quality
from .base import WITH, decisions
from .registry import query, table


def in_list(words):
    return "(" + ", ".join("'" + w + "'" for w in words) + ")"


CLEAN = "regexp_replace(html, '<[^>]+>', ' ', 'g')"
for _e, _c in X.ENTITIES:
    CLEAN = f"replace({CLEAN}, '{_e}', '{_c.replace(chr(39), chr(39) * 2)}')"
CLEAN = rf"regexp_replace(regexp_replace({CLEAN}, '[ \t]+', ' ', 'g'), '^\s+|\s+$', '', 'g')"


@query(f"SELECT page_id, md5({CLEAN}) AS clean_md5, length({CLEAN}) AS n_chars FROM pages")
def clean_text(spark, sf_dir):
    c = X.clean_text("html")
    return table(spark, sf_dir, "pages").select("page_id", F.md5(c).alias("clean_md5"), F.length(c).cast("long").alias("n_chars"))


LINES = r"regexp_replace(regexp_replace(regexp_replace(html, '(?s)<script[^>]*>.*?</script>', '', 'g'), '(?s)<style[^>]*>.*?</style>', '', 'g'), '<[^>]+>', chr(10), 'g')"
for _e, _c in X.ENTITIES[:4]:
    LINES = f"replace({LINES}, '{_e}', '{_c}')"
LINES = rf"[regexp_replace(x, '^\s+|\s+$', '', 'g') for x in string_split(regexp_replace({LINES}, '&#\d+;', '', 'g'), chr(10))]"


@query(f"SELECT page_id, md5(array_to_string(l, chr(10))) AS text_md5, len(l) AS n_lines FROM (SELECT page_id, [x for x in {LINES} if x <> ''] AS l FROM pages)")
def html_to_text_regex(spark, sf_dir):
    t = X.html_to_text("html")
    return table(spark, sf_dir, "pages").select("page_id", F.md5(t).alias("text_md5"), F.when(t == "", 0).otherwise(F.size(F.split(t, "\n"))).cast("long").alias("n_lines"))


_COUNTS = ", ".join(f"len([x for x in w if x IN {in_list(ws)}]) AS {k}" for k, ws in X.LANGUAGE_WORDS.items())


@query(
    rf"""WITH t AS (SELECT doc_id, regexp_extract_all(lower(substring(text, 1, 5000)), '[\p{{L}}\p{{N}}_]+') AS w FROM documents), c AS (SELECT doc_id, {_COUNTS} FROM t)
    SELECT doc_id, CASE WHEN de >= fr AND de >= it THEN 'de' WHEN fr >= it THEN 'fr' ELSE 'it' END AS language FROM c"""
)
def detect_language(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.detect_language("text").alias("language"))


_PARTS = ", ".join("(" + " + ".join(f"CAST((length(h) - length(replace(h, '{w}', ''))) / {len(w)} AS BIGINT)" for w in ws) + f") AS {k}" for k, ws in X.LANGUAGE_PARTS.items())


@query(
    f"""WITH t AS (SELECT doc_id, lower(substring(text, 1, 2000)) AS h FROM documents), c AS (SELECT doc_id, {_PARTS} FROM t)
    SELECT doc_id, CASE WHEN fr > de AND fr > it THEN 'fr' WHEN it > de AND it > fr THEN 'it' ELSE 'de' END AS language FROM c"""
)
def detect_language_by_parts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.detect_language_by_parts("text").alias("language"))


PLAIN = "regexp_replace(upper(docket_number), '[^A-Z0-9]', '', 'g')"
CANONICAL = f"concat_ws('|', court, CASE WHEN court = 'bge' THEN regexp_replace({PLAIN}, '^(?:CH)?(?:BGE|ATF|DTF)', '') ELSE {PLAIN} END, substring(replace(coalesce(decision_date, ''), '-', ''), 1, 8))"


@query(f"{WITH} SELECT decision_id, {CANONICAL} AS canonical_key FROM decisions")
def canonical_key(spark, sf_dir):
    return decisions(spark, sf_dir).select("decision_id", X.canonical_key("court", "docket_number", "decision_date").alias("canonical_key"))


NORM = "regexp_replace(regexp_replace(translate(upper(trim(docket_number)), '-./', '___'), '_+', '_', 'g'), '^_+|_+$', '', 'g')"


@query(
    rf"""{WITH} SELECT decision_id, docket_norm, CASE WHEN regexp_matches(docket_norm, '^[1-9][A-Z]_\d') THEN 'bger' WHEN regexp_matches(docket_norm, '^[A-F]_\d{{1,6}}_\d{{4}}$') THEN 'bvger'
        WHEN regexp_matches(docket_norm, '^[A-Z]{{2}}_') AND substring(docket_norm, 1, 2) IN {in_list(X.TWO_LETTER_PREFIXES)} THEN 'bstger' END AS inferred,
        court || '_' || regexp_replace(trim(docket_number), '[/\\]', '_', 'g') AS made_id
    FROM (SELECT *, {NORM} AS docket_norm FROM decisions)"""
)
def docket_forms(spark, sf_dir):
    d = decisions(spark, sf_dir).withColumn("docket_norm", X.docket_norm("docket_number"))
    return d.select("decision_id", "docket_norm", X.infer_court("docket_norm").alias("inferred"), X.decision_id("court", "docket_number").alias("made_id"))


@query(
    r"""SELECT c_custkey, 'src_' || regexp_replace(regexp_replace(c_name, '[^a-zA-Z0-9_.-]', '_', 'g'), '^_+|_+$', '', 'g')
        || CASE WHEN c_custkey % 3 = 0 THEN '_S' || c_custkey WHEN c_custkey % 3 = 1 THEN '_20200101' ELSE '' END AS feed_id FROM customer"""
)
def feed_ids(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 3
    return c.select("c_custkey", X.feed_id(F.lit("src"), "c_name", F.when(k == 0, F.concat(F.lit("S"), F.col("c_custkey").cast("string"))), F.when(k == 1, "2020-01-01").otherwise("")).alias("feed_id"))


@query("SELECT CASE WHEN n_chars = 0 THEN 'empty' WHEN n_chars < 500 THEN '1-499' WHEN n_chars < 1000 THEN '500-999' WHEN n_chars < 3000 THEN '1000-2999' ELSE '3000+' END AS class, count(*) AS n FROM documents GROUP BY 1")
def text_length_buckets(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(X.length_class("n_chars").alias("class")).agg(F.count("*").alias("n"))


@query(
    r"""SELECT doc_id, CASE WHEN length(t) <= 220 THEN t ELSE rtrim(substring(t, 1, 219)) || '…' END AS short FROM (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents)"""
)
def truncated(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.truncate("text").alias("short"))


@query(
    """SELECT doc_id, CASE WHEN p > 0 THEN CASE WHEN s > 1 THEN '...' ELSE '' END || substring(text, s, e - s) || CASE WHEN e <= length(text) THEN '...' ELSE '' END END AS snippet
    FROM (SELECT doc_id, text, p, greatest(p - 100, 1) AS s, least(length(text) + 1, p + 200) AS e FROM (SELECT doc_id, text, instr(lower(text), 'tion') AS p FROM documents))"""
)
def snippets(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.snippet("text", "tion the").alias("snippet"))


@query(f"{WITH} SELECT decision_id, CASE WHEN length(coalesce(regeste, '')) >= 20 THEN regeste WHEN full_text <> '' THEN substring(full_text, 1, 500) END AS chosen FROM decisions")
def selected_text(spark, sf_dir):
    return decisions(spark, sf_dir).select("decision_id", X.select_text("regeste", "full_text").alias("chosen"))


@query("SELECT doc_id, md5(text) AS hash, ascii(substring(text, 1, 1)) AS first_code FROM documents")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.content_hash("text").alias("hash"), F.ascii(F.substring("text", 1, 1)).alias("first_code"))


DATE_FORMS = """CASE o_orderkey % 8 WHEN 0 THEN CAST(day(o_orderdate) AS STRING) || '.' || CAST(month(o_orderdate) AS STRING) || '.' || CAST(year(o_orderdate) AS STRING)
    WHEN 1 THEN 'am ' || CAST(CAST(o_orderdate AS DATE) AS STRING) || ' eröffnet' WHEN 2 THEN CAST(day(o_orderdate) AS STRING) || '. März ' || CAST(year(o_orderdate) AS STRING)
    WHEN 3 THEN 'du ' || CAST(day(o_orderdate) AS STRING) || ' août ' || CAST(year(o_orderdate) AS STRING) WHEN 4 THEN CAST(day(o_orderdate) AS STRING) || ' dicembre ' || CAST(year(o_orderdate) AS STRING)
    WHEN 5 THEN CAST(year(o_orderdate) AS STRING) WHEN 6 THEN '31.2.' || CAST(year(o_orderdate) AS STRING) ELSE 'ohne Datum' END"""


@query(
    """SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN CAST(o_orderdate AS DATE) WHEN 2 THEN make_date(year(o_orderdate), 3, day(o_orderdate))
        WHEN 3 THEN make_date(year(o_orderdate), 8, day(o_orderdate)) WHEN 4 THEN make_date(year(o_orderdate), 12, day(o_orderdate)) WHEN 5 THEN make_date(year(o_orderdate), 1, 1) END AS parsed FROM orders"""
)
def parsed_dates(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr(DATE_FORMS).alias("s")).select("o_orderkey", X.parse_date("s").alias("parsed"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(year(o_orderdate) AS VARCHAR) || '-01-01' END AS from_docket,
        CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS from_text FROM orders"""
)
def extracted_dates(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k, d = F.col("o_orderkey") % 3, F.col("o_orderdate")
    docket = F.when(k < 2, F.concat(F.lit("6B_1234/"), F.year(d).cast("string"))).otherwise("B.12345")
    body = F.when(k == 0, F.date_format(d, "'Urteil vom' d. M. yyyy")).when(k == 1, F.date_format(d, "'Arrêt' yyyy-MM-dd")).otherwise("sans date 12.13.2001")
    return o.select("o_orderkey", X.date_from_docket(docket).alias("from_docket"), X.date_from_text(body).alias("from_text"))


A, B, C_, D_ = "(100 + (doc_id + 1) % 50)", "((doc_id + 1) % 200)", "(100 + (doc_id + 6) % 50)", "((doc_id + 6) % 200)"
E_ = "((doc_id - doc_id % 5 + 195) % 200)"


@query(f"SELECT doc_id, 'ART.' || (doc_id % 50 + 1) || '.ABS.' || (doc_id % 4 + 1) || '.OR;ART.' || (doc_id % 30 + 1) || '.ZGB' AS statutes FROM documents")
def statute_references(spark, sf_dir):
    found = R.statute_references("refs")
    return decisions(spark, sf_dir).select("doc_id", F.array_join(F.transform(found, lambda x: x["normalized"]), ";").alias("statutes"))


@query(f"SELECT doc_id, 'BGE ' || {A} || ' III ' || {B} || ';4A_' || {E_} || '_2019;' || {C_} || ' III ' || {D_} AS citations FROM documents")
def case_citations(spark, sf_dir):
    found = R.case_citations("refs")
    return decisions(spark, sf_dir).select("doc_id", F.array_join(F.transform(found, lambda x: x["normalized"]), ";").alias("citations"))


@query(f"SELECT doc_id, '4A_' || {E_} || '/2019;BGE ' || {A} || ' III ' || {B} AS cited, 'BGE ' || {A} || ' III ' || {B} || ';4A_' || {E_} || '/2019' AS in_document FROM documents")
def cited_decisions(spark, sf_dir):
    return decisions(spark, sf_dir).select("doc_id", F.array_join(R.cited_decisions("refs"), ";").alias("cited"), F.array_join(R.document_citations("refs"), ";").alias("in_document"))


def _months(names):
    return "[" + ", ".join("'" + n + "'" for n in names) + "]"


_DATE = "coalesce(try_cast(decision_date AS DATE), CASE WHEN decision_date = '2015' THEN DATE '2015-01-01' END)"


def _citation_sql(lang, prefix, names, dot, courts, label):
    months = _months(names)
    court = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in courts.items())
    written = f"CASE WHEN {_DATE} IS NULL THEN '' ELSE '{prefix} ' || day({_DATE}) || '{dot} ' || ({months})[month({_DATE})] || ' ' || year({_DATE}) END"
    return f"""'(' || CASE WHEN court = 'bge' THEN '{courts['bge']} ' || regexp_replace(docket_number, '^(?:BGE|ATF|DTF)\\s+', '') ELSE CASE court {court} ELSE court END || ' ' || docket_number
        || CASE WHEN coalesce(decision_date, '') <> '' THEN ' ' || {written} ELSE '' END END || ', {label} 2.1)' AS cited_{lang}"""


@query(
    f"{WITH} SELECT decision_id, "
    + _citation_sql("de", "vom", [m.capitalize() for m in X.MONTHS["de"]], ".", {"bger": "BGer", "bge": "BGE", "bvger": "BVGer"}, "E.")
    + ", "
    + _citation_sql("fr", "du", X.MONTHS["fr"], "", {"bger": "TF", "bge": "ATF", "bvger": "TAF"}, "consid.")
    + " FROM decisions"
)
def formatted_citations(spark, sf_dir):
    d = decisions(spark, sf_dir)
    return d.select("decision_id", *(R.formatted_citation("court", "docket_number", "decision_date", lang, F.lit("2.1")).alias(f"cited_{lang}") for lang in ("de", "fr")))


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'AS' WHEN 1 THEN 'BBl' WHEN 2 THEN 'FF' ELSE 'RO' END AS kind, CAST(1990 + doc_id % 30 AS INT) AS year, CAST(doc_id % 5000 + 1 AS INT) AS page FROM documents""")
def amendment_references(spark, sf_dir):
    kind = F.expr("CASE doc_id % 4 WHEN 0 THEN 'AS' WHEN 1 THEN 'BBl' WHEN 2 THEN 'FF' ELSE 'RO' END")
    body = F.concat("text", F.lit("\nFassung gemäss ("), kind, F.lit(" "), (1990 + F.col("doc_id") % 30).cast("string"), F.lit(" "), (F.col("doc_id") % 5000 + 1).cast("string"), F.lit(")"))
    d = table(spark, sf_dir, "documents").select("doc_id", F.explode(R.amendment_references(body)).alias("a"))
    return d.select("doc_id", "a.kind", "a.year", "a.page")


@query(
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN regexp_replace(h, '^\\s+|\\s+$', '', 'g') END AS regeste,
        CASE WHEN doc_id % 3 = 0 AND length(s) > 10 THEN s END AS title
    FROM (SELECT doc_id, 'Kopf ' || regexp_replace(substring(text, 1, 40), '\\s+', ' ', 'g') || ' Ende der Regeste' AS h, trim('Forderung ' || doc_id) AS s FROM documents)"""
)
def headnotes_and_titles(spark, sf_dir):
    head = F.concat(F.lit("Kopf "), F.regexp_replace(F.substring("text", 1, 40), r"\s+", " "), F.lit(" Ende der Regeste"))
    body = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Urteil\nGegenstand: Forderung "), F.col("doc_id").cast("string"), F.lit("\n\nRegeste:\n"), head, F.lit("\nSachverhalt\nA. Der Kläger"))).otherwise("Nichts davon")
    d = table(spark, sf_dir, "documents").select("doc_id", body.alias("full_text"))
    return d.select("doc_id", quality.regeste_from_text("full_text").alias("regeste"), quality.title_from_text("full_text").alias("title"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '133' WHEN 1 THEN '140' END AS volume, CASE o_orderkey % 4 WHEN 0 THEN 'III' WHEN 1 THEN 'IV' END AS division, CASE WHEN o_orderkey % 4 < 2 THEN CAST(o_orderkey % 900 + 1 AS VARCHAR) END AS page FROM orders")
def report_references(spark, sf_dir):
    k, p = F.col("o_orderkey") % 4, (F.col("o_orderkey") % 900 + 1).cast("string")
    s = F.when(k == 0, F.concat(F.lit("BGE 133 iii "), p)).when(k == 1, F.concat(F.lit(" 140 IV "), p)).when(k == 2, F.concat(F.lit("BGE III "), p)).otherwise("")
    return table(spark, sf_dir, "orders").select("o_orderkey", X.report_reference(s).alias("r")).select("o_orderkey", "r.volume", "r.division", "r.page")


@query("SELECT p_partkey, 'cc' AS kind, CAST(1900 + p_partkey % 100 AS VARCHAR) AS year, CAST(p_partkey AS VARCHAR) AS number FROM part")
def eli_parts(spark, sf_dir):
    url = F.concat(F.lit("https://www.fedlex.admin.ch/eli/cc/"), (1900 + F.col("p_partkey") % 100).cast("string"), F.lit("/"), F.col("p_partkey").cast("string"), F.lit("/de"))
    return table(spark, sf_dir, "part").select("p_partkey", X.eli_parts(url).alias("e")).select("p_partkey", "e.kind", "e.year", "e.number")
