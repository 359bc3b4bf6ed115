"""Full-text retrieval over postings: BM25, boolean queries, fusion, reranking, snippets.

Queries are parsed on the driver into small trees. All terms of a query, of all its strategies, select their postings at once;
these meet by document, and each tree is a condition on the postings of a document. No text is read before the last few rows.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ACCENTED, PLAIN, text, tokens
from .compounds import of_words
from .index import Index, postings  # noqa: F401
from .lineage import checkpointed, numbered

#: Weights of fields and of signals.
FIELD_WEIGHTS = {"decision_id": 0.8, "court": 0.8, "canton": 0.8, "docket_number": 2.0, "language": 0.8, "title": 6.0, "regeste": 5.0, "full_text": 1.2}
WEIGHTS = {
    "docket_exact": 6.0, "docket_partial": 2.0, "title": 3.0, "regeste": 2.2, "snippet": 0.8, "phrase": 1.8, "rrf": 32.0, "hits": 0.18, "hits_cap": 8,
    "statute": 2.2, "statute_per_mention": 0.25, "statute_cap": 1.2, "citation": 2.4, "citation_per_hit": 0.30, "citation_cap": 1.2,
    "authority": 0.03, "authority_cap": 1.0, "in_pool": 0.5, "in_pool_cap": 1.2, "in_pool_least": 2, "language": 0.9, "asylum": 1.7, "intent": 0.65, "accelerated": 0.9,
}
STRATEGY_WEIGHTS = {"nl_and": 1.3, "nl_or": 1.0, "quoted": 1.15, "regeste_focus": 1.05, "title_focus": 0.95, "nl_or_expanded": 0.85, "raw": 1.5}
#: Own choice: strategies of the rarest words, of the rarest pairs, and of the query's language.
ANCHOR_WEIGHT, PAIR_WEIGHT, LANGUAGE_WEIGHT, ANCHORS, PAIRS = 0.9, 1.1, 1.1, 2, 3
RRF_CONSTANT, K1, B = 60, 1.2, 0.75
#: A small dictionary of synonyms across languages and from everyday words to those of the law; pass a larger one as a table's rows.
SYNONYMS = {
    "kündigung": ["résiliation", "disdetta"], "miete": ["bail", "locazione"], "mietrecht": ["mietzins", "kündigung", "bail"], "asyl": ["asile", "asilo", "schutz"], "asile": ["asyl", "asilo"],
    "wegweisung": ["renvoi", "allontanamento"], "renvoi": ["wegweisung", "allontanamento"], "haftung": ["responsabilité", "responsabilità"], "arbeitsvertrag": ["contrat de travail", "contratto di lavoro"],
    "steuer": ["impôt", "imposta"], "vertrag": ["contrat", "contratto"], "scheidung": ["divorce", "divorzio"], "hundebiss": ["tierhalterhaftung", "haftpflicht"], "autounfall": ["haftpflicht", "kausalzusammenhang"],
    "erbschaft": ["erbrecht", "pflichtteil"], "geschäftsführer": ["organverantwortlichkeit", "sorgfaltspflicht"], "geschaeftsfuehrer": ["organverantwortlichkeit", "sorgfaltspflicht"],
    "beschleunigtes": ["verkürzte", "accéléré"], "windpark": ["parc éolien", "parco eolico"], "baubewilligung": ["permis de construire", "licenza edilizia"],
}
#: Own choice: words that carry no meaning in a question, by language, folded.
QUESTION_WORDS = {
    "de": set("der die das den dem des ein eine einer eines einem einen und oder im in zu zum zur von vom mit für fur ich suche ist sind wird wurde uber über auf bei nach nicht urteil entscheid wie was wann kann darf".split()),
    "fr": set("le la les l un une des du de d et ou en dans sur pour par avec je cherche est sont qui que quoi quand comment au aux ce cette arret jugement il elle ne pas".split()),
    "it": set("il lo la gli i le un una dei delle del della di e o in nel nella su per con da cerco sono che quando come al alla sentenza decisione non".split()),
    "en": set("the a an and or of in on for by with i am is are was were what when how which looking decision judgment not to".split()),
}
_FOLD = str.maketrans(ACCENTED, PLAIN)


def fold(word: str) -> str:
    return word.lower().translate(_FOLD)


def words_of(query: str) -> list[str]:
    return [w for w in re.split(r"[^\w]+|_", fold(query)) if w]


# BM25 ----------------------------------------------------------------------------------------


def document_frequencies(index: DataFrame) -> DataFrame:
    return index.groupBy("term").agg(F.countDistinct("doc").alias("df"))


def field_weight(fields: dict[str, float]) -> Column:
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for pair in fields.items() for x in pair)), F.col("field")), F.lit(0.0))


def length_in(index: Index, fields) -> str:
    """The column of a posting that has the length of a document: that of the one field asked for, or of all."""
    return "own" if len(list(fields)) == 1 and len(index.words) > 1 else "length"


def scored(asked: DataFrame, index: Index, fields: dict[str, float]) -> DataFrame:
    """Postings of some terms as (doc, term, part): what a term adds to a document's BM25."""
    per = asked.groupBy("doc", "term").agg(F.sum(F.col("tf") * field_weight(fields)).alias("f"), F.max(length_in(index, fields)).alias("length"))
    per = per.join(F.broadcast(document_frequencies(asked)), "term")  # a row for each term of the queries
    idf = F.log(1 + (F.lit(index.docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    mean = index.mean_length(list(fields)) or 1.0
    return per.select("doc", "term", (idf * F.col("f") * (K1 + 1) / (F.col("f") + K1 * (1 - B + B * F.col("length") / mean))).alias("part"))


def bm25(index: Index, terms: list[str], fields: dict[str, float]) -> DataFrame:
    """(doc, score) of the documents with any of the terms; higher is better."""
    return scored(index.asked(terms, fields=list(fields)), index, fields).groupBy("doc").agg(F.sum("part").alias("score"))


#: Rows of queries that are joined by term, those of a pack that is broadcast, and documents of a task.
FEW_ROWS, PACK_ROWS, TASK_DOCS = 1000, 50_000, 2048


def bm25_batch(index: Index, queries: DataFrame, fields: dict[str, float]) -> DataFrame:
    """(query_id, doc, score) for a table of queries (query_id, term), whose size is not bounded.

    A term's postings meet the queries that ask for it: for few rows of queries by term, for more of them document by document.
    """
    asked = index.rows.join(queries.select("term").distinct(), "term", "left_semi")
    if set(fields) < set(index.words):
        asked = asked.where(F.col("field").isin(list(fields)))
    per = asked.groupBy("doc", "term").agg(F.sum(F.col("tf") * field_weight(fields)).alias("f"), F.max(length_in(index, fields)).alias("length"))
    idf = F.log(1 + (F.lit(index.docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    mean = index.mean_length(list(fields)) or 1.0
    part = idf * F.col("f") * (K1 + 1) / (F.col("f") + K1 * (1 - B + B * F.col("length") / mean))
    parts = per.join(document_frequencies(asked), "term").select("doc", "term", part.alias("part"))
    rows = queries.count()
    if rows <= FEW_ROWS:
        return queries.join(parts, "term").groupBy("query_id", "doc").agg(F.sum("part").alias("score"))
    # all postings of a document lie in one task, to which packs of queries are sent: what they score is summed up there and not shuffled
    packs = -(-rows // PACK_ROWS)
    dealt = checkpointed(parts.repartition(max(1, -(-index.docs // TASK_DOCS)), "doc"))
    pack = F.pmod(F.xxhash64("query_id"), F.lit(packs))
    found = None
    for p in range(packs):
        own = dealt.join(F.broadcast(queries.where(pack == p)), "term").groupBy("query_id", "doc").agg(F.sum("part").alias("score"))
        found = own if found is None else found.unionByName(own)
    return found


#: Documents of a block, how many times more blocks each round has, pairs of a task, tasks of a round that blocks are copied for, and rows of pairs and blocks of a round.
BLOCK_DOCS, WIDER, TASK_PAIRS, COPIED_TASKS, ROUND_ROWS = 4096, 8, 4096, 64, 4_000_000


def _ahead(pairs: pa.Table, docs: pa.Table) -> pa.Table:
    """(query_id, doc, ahead): how many of the documents given are before the one of each pair. Terms are added up in the order in which the goal was."""
    docs = docs.sort_by("doc")
    names, terms = docs["doc"].to_pylist(), docs["terms"].combine_chunks()
    asked = pairs["terms"].combine_chunks()
    known = asked.flatten().unique()
    code = pc.index_in(terms.flatten(), value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
    order = np.argsort(code, kind="stable")
    row = np.repeat(np.arange(len(names)), pc.list_value_length(terms).to_numpy(zero_copy_only=False))[order]
    part = docs["parts"].combine_chunks().flatten().to_numpy(zero_copy_only=False)[order]
    starts = np.searchsorted(code[order], np.arange(len(known) + 1))
    own = pc.index_in(asked.flatten(), value_set=known).to_numpy(zero_copy_only=False)
    weight = pairs["weights"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.list_value_length(asked).to_numpy(zero_copy_only=False))
    begin, ahead = 0, []
    for end, goal, doc in zip(ends, pairs["goal"].to_pylist(), pairs["doc"].to_pylist()):
        spans = [(slice(starts[c], starts[c + 1]), w) for c, w in zip(own[begin:end], weight[begin:end])]
        score = np.bincount(np.concatenate([row[s] for s, _ in spans]), np.concatenate([part[s] * w for s, w in spans]), len(names))
        rounded, place = np.floor(score * 1e9 + 0.5), bisect_left(names, doc)
        ahead.append(np.count_nonzero(rounded > goal) + np.count_nonzero((rounded[:place] == goal) & (score[:place] > 0)))
        begin = end
    return pa.table({"query_id": pairs["query_id"], "doc": pairs["doc"], "ahead": pa.array(ahead, pa.int64())})


def placed(index: Index, queries: DataFrame, pairs: DataFrame, fields: dict[str, float], k: int) -> DataFrame:
    """(query_id, doc, rank) of those pairs (query_id, doc) whose document is among the k best by BM25 for the query's words (query_id, term); scores
    are compared with nine decimals, equals by doc.

    A pair is out as soon as k documents are before it. So it meets a block of documents first, and as long as it isn't out ever more of
    them, all in the end: few pairs do, unless most documents are among the best.
    """
    asked = index.rows.join(queries.select("term").distinct(), "term", "left_semi")
    if set(fields) < set(index.words):
        asked = asked.where(F.col("field").isin(list(fields)))
    blocks = max(1, -(-index.docs // BLOCK_DOCS))
    by_doc = asked.repartition(max(blocks, 2 * asked.sparkSession.sparkContext.defaultParallelism), "doc")
    per = by_doc.groupBy("doc", "term").agg(F.sum(F.col("tf") * field_weight(fields)).alias("f"), F.max(length_in(index, fields)).alias("length"))
    part = F.col("f") * (K1 + 1) / (F.col("f") + K1 * (1 - B + B * F.col("length") / (index.mean_length(list(fields)) or 1.0)))
    listed = per.groupBy("doc").agg(F.collect_list(F.struct("term", part.alias("part"))).alias("x"))
    docs = checkpointed(listed.select("doc", F.pmod(F.xxhash64("doc"), F.lit(blocks)).cast("int").alias("block"), F.col("x.term").alias("terms"), F.col("x.part").alias("parts")))

    df = docs.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.lit(index.docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = queries.join(df, "term").groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("term", idf.alias("weight")))).alias("q"))
    met = pairs.join(weighed, "query_id").join(docs, "doc").withColumn("m", F.map_from_arrays("terms", "parts"))
    score = F.aggregate("q", F.lit(0.0), lambda s, x: s + F.coalesce(F.try_element_at(F.col("m"), x["term"]), F.lit(0.0)) * x["weight"])
    met = met.select("query_id", "doc", "q", score.alias("score")).where("score > 0")
    goal = F.floor(F.col("score") * 1e9 + 0.5).cast("double").alias("goal")
    live = checkpointed(met.select("query_id", "doc", goal, F.col("q.term").alias("terms"), F.col("q.weight").alias("weights"), F.lit(0).cast("long").alias("before")))

    kinds = {f.name: f.dataType.simpleString() for f in live.schema}
    at, wide = 0, 1
    while at < blocks and (n := live.count()):
        end = min(blocks, at + min(wide, max(1, ROUND_ROWS // n)))
        pieces = max(1, min(-(-n // TASK_PAIRS), COPIED_TASKS // (end - at)))
        key, tasks = ["piece", "block"], pieces * (end - at)
        piece = F.pmod(F.xxhash64("query_id", "doc"), F.lit(pieces)).cast("int")
        mine = live.withColumn("piece", piece).withColumn("block", F.explode(F.sequence(F.lit(at), F.lit(end - 1)))).repartition(tasks, *key)
        theirs = docs.where(F.col("block").between(at, end - 1)).withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)))).repartition(tasks, *key)
        ahead = mine.groupBy(*key).cogroup(theirs.groupBy(*key)).applyInArrow(lambda a, b: _ahead(a, b), f"query_id {kinds['query_id']}, doc {kinds['doc']}, ahead long")
        live = live.join(ahead.groupBy("query_id", "doc").agg(F.sum("ahead").alias("ahead")), ["query_id", "doc"])
        live = checkpointed(live.withColumn("before", F.col("before") + F.col("ahead")).drop("ahead").where(F.col("before") < k))
        at, wide = end, wide * WIDER
    return live.select("query_id", "doc", (F.col("before") + 1).alias("rank"))


def ranked(scores: DataFrame, by: str = "score", key: list[str] = (), doc: str = "doc") -> DataFrame:
    """rank from 1, best first, equals by doc; without a key over all rows, which are dealt out by ranges and counted."""
    order = [F.desc(by), F.asc(doc)]
    if key:
        return scores.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return numbered(scores, "rank", *order)


# query language ------------------------------------------------------------------------------


@dataclass
class Query:
    kind: str  # and, or, not, term, phrase, prefix
    parts: list[Query] = field(default_factory=list)
    words: list[str] = field(default_factory=list)
    column: str | None = None


def parse(query: str) -> Query:
    """AND (also by juxtaposition), OR, NOT, "phrases", prefix* and column:term, with parentheses."""
    items = re.findall(r'(?:\w+:)?"[^"]*"|[()]|[^\s()"]+', query)
    at = 0

    def leaf(item: str) -> Query:
        column = None
        if m := re.match(r"^(\w+):(.+)$", item, re.S):
            column, item = m[1], m[2]
        if item.startswith('"'):
            return Query("phrase", words=words_of(item), column=column)
        ws = words_of(item)
        if item.endswith("*") and ws:
            return Query("prefix", words=ws[-1:], column=column)
        return Query("term", words=ws[:1], column=column) if len(ws) == 1 else Query("phrase", words=ws, column=column)

    def either() -> Query:
        nonlocal at
        parts = [both()]
        while at < len(items) and items[at].upper() == "OR" and items[at] == items[at].upper():
            at += 1
            parts.append(both())
        return parts[0] if len(parts) == 1 else Query("or", parts)

    def both() -> Query:
        nonlocal at
        parts, negative = [], []
        while at < len(items) and items[at] not in (")", "OR"):
            if items[at] == "AND":
                at += 1
                continue
            no = items[at] == "NOT"
            if no:
                at += 1
                if at >= len(items):
                    break
            if items[at] == "(":
                at += 1
                q = either()
                at += at < len(items) and items[at] == ")"
            else:
                q = leaf(items[at])
                at += 1
            (negative if no else parts).append(q)
        q = parts[0] if len(parts) == 1 else Query("and", parts)
        return Query("and", [q, *(Query("not", [x]) for x in negative)]) if negative else q

    return either()


def matches(q: Query, fields: list[str]) -> Column:
    """A condition on ``hits``, a document's postings array<struct<field, term, tf, positions>>."""
    if q.kind in ("and", "or"):
        parts = [matches(x, fields) for x in q.parts]
        return reduce((lambda a, b: a & b) if q.kind == "and" else (lambda a, b: a | b), parts, F.lit(q.kind == "and")) if parts else F.lit(False)
    if q.kind == "not":
        return ~matches(q.parts[0], fields)
    if not q.words:
        return F.lit(False)
    used = [q.column] if q.column in fields else fields
    if q.kind == "prefix":
        return F.exists("hits", lambda h: h["field"].isin(used) & h["term"].startswith(q.words[0]))
    if q.kind == "term":
        return F.exists("hits", lambda h: h["field"].isin(used) & (h["term"] == q.words[0]))

    def places(f: str, i: int, word: str) -> Column:
        """Where a phrase would begin that has the word at place i."""
        own = F.get(F.filter("hits", lambda h: (h["field"] == f) & (h["term"] == word)), F.lit(0))["positions"]
        return F.transform(F.coalesce(own, F.array().cast("array<int>")), lambda p: p - i)

    def phrase(f: str) -> Column:
        return F.size(reduce(F.array_intersect, [places(f, i, w) for i, w in enumerate(q.words)])) > 0

    return reduce(lambda a, b: a | b, map(phrase, used))


def leaves(q: Query) -> list[str]:
    return list(dict.fromkeys(q.words if q.kind in ("term", "phrase") else [w for x in q.parts if x.kind != "not" for w in leaves(x)]))


def all_words(q: Query, kinds: tuple[str, ...]) -> list[str]:
    """Words of the parts of some kinds, those that must not be there as well."""
    return list(q.words) if q.kind in kinds else [w for x in q.parts for w in all_words(x, kinds)]


def run(index: Index, trees: list[tuple[str, Query]], fields: dict[str, float], allowed: DataFrame | None = None) -> DataFrame:
    """(name, doc, score) of the documents that match each tree, from one reading of the postings of all of them.

    allowed: (doc) that may be found; scores are those of the whole index.
    """
    terms, prefixes = (list(dict.fromkeys(w for _, q in trees for w in all_words(q, kinds))) for kinds in (("term", "phrase"), ("prefix",)))
    placed = list(dict.fromkeys(w for _, q in trees for w in all_words(q, ("phrase",))))
    # only words of phrases need their places; without phrases none is read
    places = F.when(F.col("term").isin(placed), F.col("positions")) if placed else F.lit(None).cast("array<int>")
    asked = index.asked(terms, prefixes, list(fields)).withColumn("positions", places)
    length = length_in(index, fields)
    per = asked.groupBy("doc").agg(F.collect_list(F.struct("field", "term", "tf", "positions")).alias("hits"), F.max(length).alias("length"))
    if allowed is not None:
        per = per.join(allowed, "doc", "left_semi")
    known = index.frequencies(terms, list(fields))
    mean = index.mean_length(list(fields)) or 1.0
    weights = F.create_map(*(F.lit(x) for pair in fields.items() for x in pair))

    def part(t: str) -> Column:
        f = F.aggregate(F.filter("hits", lambda h: h["term"] == t), F.lit(0.0), lambda a, h: a + h["tf"] * F.coalesce(F.element_at(weights, h["field"]), F.lit(0.0)))
        idf = math.log(1 + (index.docs - known[t] + 0.5) / (known[t] + 0.5))
        return idf * f * (K1 + 1) / (f + K1 * (1 - B + B * F.col("length") / mean))

    parts = per.select("doc", "hits", *(part(t).alias(f"_{i}") for i, t in enumerate(known)))
    at = {t: F.col(f"_{i}") for i, t in enumerate(known)}
    found = [F.when(matches(q, list(fields)), F.struct(F.lit(name).alias("name"), sum((at[t] for t in leaves(q) if t in at), F.lit(0.0)).alias("score"))) for name, q in trees]
    return parts.select("doc", F.explode(F.array_compact(F.array(*found))).alias("x")).select("x.name", "doc", "x.score")


def search(df: DataFrame, query: str, fields: dict[str, float] | None = None, filters: Column | None = None, limit: int | None = 20, offset: int = 0, id_col: str = "decision_id", index: Index | None = None) -> DataFrame:
    """(doc, score) of the rows that match the query, best first; without a limit all of them, in no order."""
    fields = fields or {f: w for f, w in FIELD_WEIGHTS.items() if f in df.columns}
    index = index or Index.of(df, list(fields), id_col)
    allowed = None if filters is None else df.where(filters).select(F.col(id_col).alias("doc"))
    found = run(index, [("", parse(query))], fields, allowed).select("doc", "score")
    return found if limit is None else found.orderBy(F.desc("score"), "doc").offset(offset).limit(limit)


def total(df: DataFrame, query: str, fields: dict[str, float] | None = None, filters: Column | None = None, id_col: str = "decision_id", index: Index | None = None) -> DataFrame:
    """(total) of the rows that match, beside a page of them."""
    return search(df, query, fields, filters, None, 0, id_col, index).agg(F.count("*").alias("total"))


def conjunctive(court=None, canton=None, language=None, date_from=None, date_to=None, chamber=None, decision_type=None) -> Column:
    """The optional filters of a search, all of which must hold."""
    out = F.lit(True)
    for c, v in (("court", court), ("canton", canton and canton.upper()), ("language", language and language.lower()), ("chamber", chamber), ("decision_type", decision_type)):
        if v:
            out &= F.col(c) == v
    if date_from:
        out &= F.col("decision_date") >= date_from
    if date_to:
        out &= F.col("decision_date") <= date_to
    return out


# understanding, fusion, reranking -------------------------------------------------------------


def intent(query: str) -> str:
    """docket, explicit or natural, by the form of a query."""
    if re.search(r"\b(?:\d[A-Z]_\d+/\d{4}|[A-F]-\d+/\d{4}|(?:BGE|ATF|DTF)\s+\d+\s+[IVX]+\s+\d+)\b", query):
        return "docket"
    return "explicit" if re.search(r'"|\bAND\b|\bOR\b|\bNOT\b|\w+:\w|\w\*', query) else "natural"


def inline_dockets(query: str) -> list[str]:
    """Dockets within a query in order, also with spaces for the signs between their parts."""
    found = [(m.start(), re.sub(r"^(\d[A-Z])[ _.](\d+)[ /](\d{4})$", r"\1_\2/\3", m[0])) for m in re.finditer(r"\b\d[A-Z][ _.]\d+[ /]\d{4}\b|\b[A-F]-\d+/\d{4}\b", query)]
    return list(dict.fromkeys(d for _, d in sorted(found)))


def docket_family(docket: str, width: int = 2) -> list[str]:
    """Dockets of the same kind and year whose serial numbers are near."""
    m = re.match(r"^(.*?)(\d+)(/\d{4})$", docket)
    return [f"{m[1]}{n}{m[3]}" for n in range(max(1, int(m[2]) - width), int(m[2]) + width + 1) if n != int(m[2])] if m else []


def umlaut_variants(word: str) -> list[str]:
    """A word with ae, oe and ue for umlauts and the other way round."""
    out = word.lower()
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue")):
        out = out.replace(a, b)
    back = word.lower()
    for a, b in (("ae", "ä"), ("oe", "ö"), ("ue", "ü")):
        back = back.replace(a, b)
    return [w for w in dict.fromkeys((out, back)) if w != word.lower()]


def expansions(words: list[str], synonyms: dict[str, list[str]] = SYNONYMS, compounds: dict[str, list[str]] | None = None) -> list[str]:
    """Words that stand beside those of a query: synonyms, the other way to write umlauts, and the parts of compounds (word: parts)."""
    known = {fold(k): v for k, v in synonyms.items()}
    out = [x for w in words for s in known.get(w, []) for x in words_of(s)] + [fold(v) for w in words for v in umlaut_variants(w)]
    out += [p for w in words for p in (compounds or {}).get(w, [])]
    return list(dict.fromkeys(x for x in out if x not in words))


def query_languages(query: str) -> list[str]:
    """Languages whose small words a query has, those with most first; none if it has none of them."""
    ws = words_of(query)
    counts = {k: sum(w in own for w in ws) for k, own in QUESTION_WORDS.items()}
    most = max(counts.values())
    return [k for k, n in sorted(counts.items(), key=lambda x: -x[1]) if n and 2 * n > most]


def content_words(query: str) -> list[str]:
    """The words of a query without small ones: those of its languages, or of all if they leave nothing."""
    small = set().union(*(QUESTION_WORDS[k] for k in query_languages(query)), {"d", "l"})
    ws = [w for w in dict.fromkeys(words_of(query)) if len(w) > 1 or w.isdigit()]
    return [w for w in ws if w not in small] or ws


def anchors(words: list[str], frequencies: dict[str, int] | None, docs: int) -> tuple[list[str], list[tuple[str, str]]]:
    """The rarest words of a query and its rarest pairs of neighbours.

    Words that no document has are no anchors. A pair's rarity is what chance would give, the product of its
    frequencies. Without frequencies longer words count as rarer.
    """
    if frequencies is None:
        n = {w: 1 / len(w) for w in words}
        docs = 1
    else:
        n = {w: frequencies[w] for w in words if frequencies.get(w)}
    long = [w for w in words if w in n and len(w) > 3]
    single = sorted(long, key=lambda w: (n[w], words.index(w)))[:ANCHORS]
    near = [(a, b) for a, b in zip(long, long[1:], strict=False)]
    return single, sorted(near, key=lambda p: (n[p[0]] * n[p[1]] / max(1, docs), words.index(p[0])))[:PAIRS]


def strategies(
    query: str, synonyms: dict[str, list[str]] = SYNONYMS, expander=None, frequencies: dict[str, int] | None = None, docs: int = 1, compounds: dict[str, list[str]] | None = None, fields=FIELD_WEIGHTS,
) -> list[tuple[str, str, float]]:
    """(name, query, weight) of the searches that stand for a query, surest first.

    expander: more terms for a query, none by default. frequencies: documents by term, from the index, to choose anchors by;
    compounds: parts of the query's compounds. A query in one language asks for documents in that language, too.
    """
    if intent(query) == "explicit":
        return [("raw", query, STRATEGY_WEIGHTS["raw"])]
    ws = content_words(query)
    out = [("nl_and", " AND ".join(ws))]
    if len(words_of(query)) > 1:
        out.append(("quoted", '"' + " ".join(words_of(query)) + '"'))
    out += [(f"{f}_focus", " OR ".join(f"{f}:{w}" for w in ws)) for f in ("regeste", "title") if f in fields]
    out = [(name, q, STRATEGY_WEIGHTS[name]) for name, q in out]
    single, pairs = anchors(ws, frequencies, docs)
    out += [(f"anchor_pair_{a}_{b}", f"{a} AND {b}", PAIR_WEIGHT) for a, b in pairs] + [(f"anchor_{w}", w, ANCHOR_WEIGHT) for w in single if len(ws) > 1]
    if "language" in fields:
        out += [(f"lang_{k}_and", " AND ".join([f"language:{k}", *ws]), LANGUAGE_WEIGHT) for k in query_languages(query)[:1] if k != "en"]
    out.append(("nl_or", " OR ".join(ws), STRATEGY_WEIGHTS["nl_or"]))
    if more := expansions(ws, synonyms, compounds) + list(expander(query) if expander else []):
        out.append(("nl_or_expanded", " OR ".join([*ws, *more]), STRATEGY_WEIGHTS["nl_or_expanded"]))
    return out


def fuse(rankings: DataFrame, constant: int = RRF_CONSTANT) -> DataFrame:
    """Reciprocal rank fusion of (strategy, weight, doc, rank): (doc, rrf, hits)."""
    return rankings.groupBy("doc").agg(F.sum(F.col("weight") / (constant + F.col("rank"))).alias("rrf"), F.countDistinct("strategy").alias("hits"))


def coverage(c, words: list[str]) -> Column:
    """The share of the words that a column has."""
    if not words:
        return F.lit(0.0)
    w = tokens(c)
    return sum((F.array_contains(w, x).cast("double") for x in words), F.lit(0.0)) / len(words)


def signals(query: str, language: str | None = None) -> Column:
    """The sum of the signals that a candidate's own columns give."""
    ws, w = words_of(query), WEIGHTS
    dockets = inline_dockets(query)
    out = w["title"] * coverage("title", ws) + w["regeste"] * coverage("regeste", ws) + w["snippet"] * coverage("snippet", ws)
    if len(ws) > 1:
        flat = F.concat(F.lit(" "), F.array_join(tokens(F.concat_ws(" ", text("title"), text("regeste"), text("snippet"))), " "), F.lit(" "))
        out += F.when(flat.contains(" " + " ".join(ws) + " "), w["phrase"]).otherwise(0.0)
    for d in dockets:
        bare = F.regexp_replace(F.lower(text("docket_number")), "[^0-9a-z]", "")
        plain = re.sub("[^0-9a-z]", "", d.lower())
        out += F.when(bare == plain, w["docket_exact"]).when(bare.contains(plain), w["docket_partial"]).otherwise(0.0)
    if language:
        out += F.when(F.col("language") == language, w["language"]).otherwise(0.0)
    if re.search(r"\b(?:urteil|entscheid|arret|jugement|decision|sentenza|decisione)\w*", fold(query)):
        out += F.when(F.lower(text("title")).rlike(r"\b(?:urteil|entscheid|arrêt|jugement|décision|sentenza|decisione)"), w["intent"]).otherwise(0.0)
    if re.search(r"\b(?:beschleunigt|accelere|acceleree|accelerata)\w*", fold(query)):
        said = F.lower(F.concat_ws(" ", text("title"), text("regeste"), text("snippet"))).rlike(r"beschleunigte|accéléré|accelerata|accelerato")
        out += F.when(said, w["accelerated"]).otherwise(0.0)
    if re.search(r"\b(?:asyl|asile|asilo)\w*", fold(query)):
        out += F.when(F.col("court") == "bvger", w["asylum"]).when(F.col("court") == "bger", -0.2).otherwise(0.0)
    return out


def graph_signals(candidates: DataFrame, statutes: DataFrame | None = None, asked: list[str] = (), authority: DataFrame | None = None, citations: DataFrame | None = None, cited: list[str] = ()) -> DataFrame:
    """Candidates (doc) with ``graph``: mentions of the statutes asked for, citations of the decisions asked for,
    citations by other candidates (citations: source_decision_id, target_decision_id, mention_count), and authority."""
    out = candidates.withColumn("graph", F.lit(0.0))
    w = WEIGHTS
    if citations is not None:
        if cited:
            m = citations.where(F.col("target_decision_id").isin(list(cited))).groupBy(F.col("source_decision_id").alias("doc")).agg(F.sum("mention_count").alias("m"))
            c = F.when(F.col("m") > 0, w["citation"] + F.least(F.lit(w["citation_cap"]), w["citation_per_hit"] * F.col("m"))).otherwise(0.0)
            out = out.join(m, "doc", "left").withColumn("graph", F.col("graph") + c).drop("m")
        pool = candidates.select("doc").distinct()
        inner = citations.join(pool.withColumnRenamed("doc", "source_decision_id"), "source_decision_id", "left_semi").where("source_decision_id <> target_decision_id")
        n = inner.groupBy(F.col("target_decision_id").alias("doc")).agg(F.countDistinct("source_decision_id").alias("n"))
        p = F.when(F.col("n") >= w["in_pool_least"], F.least(F.lit(w["in_pool_cap"]), w["in_pool"] * F.col("n"))).otherwise(0.0)
        out = out.join(n, "doc", "left").withColumn("graph", F.col("graph") + p).drop("n")
    if statutes is not None and asked:
        m = statutes.where(F.col("statute_id").isin(list(asked))).groupBy(F.col("decision_id").alias("doc")).agg(F.sum("mention_count").alias("m"))
        s = F.when(F.col("m") > 0, WEIGHTS["statute"] + F.least(F.lit(WEIGHTS["statute_cap"]), WEIGHTS["statute_per_mention"] * F.col("m"))).otherwise(0.0)
        out = out.join(m, "doc", "left").withColumn("graph", F.col("graph") + s).drop("m")
    if authority is not None:
        out = out.join(authority.select(F.col("decision_id").alias("doc"), "authority"), "doc", "left").withColumn("graph", F.col("graph") + F.coalesce("authority", F.lit(0.0))).drop("authority")
    return out


def rerank(candidates: DataFrame, query: str, language: str | None = None) -> DataFrame:
    """Candidates (doc, bm25, rrf, hits, graph and the decision's columns) with relevance_score, best first."""
    w = WEIGHTS
    graph = F.coalesce("graph", F.lit(0.0)) if "graph" in candidates.columns else F.lit(0.0)
    total = F.coalesce("bm25", F.lit(0.0)) + w["rrf"] * F.col("rrf") + w["hits"] * F.least("hits", F.lit(w["hits_cap"])) + signals(query, language) + graph
    return candidates.withColumn("relevance_score", total).orderBy(F.desc("relevance_score"), F.col("decision_date").desc_nulls_last(), "doc")


def find(
    df: DataFrame, query: str, limit: int = 10, pool: int = 200, language: str | None = None, filters: Column | None = None, index: Index | None = None, compounds: DataFrame | None = None,
) -> DataFrame:
    """The whole way of a query: strategies, fusion, signals, order; one row a decision, never a column named rank.

    index: of df, by default made anew. The ``pool`` best of each strategy are fused; only their rows are read, if the
    index has a store of documents, else df is read once. compounds: (term, parts), to look up the query's words in.
    """
    fields = {f: w for f, w in FIELD_WEIGHTS.items() if f in df.columns}
    index = index or Index.of(df, list(fields))
    ws = content_words(query)
    runs = strategies(query, frequencies=index.frequencies(ws, list(fields)), docs=index.docs, compounds=of_words(compounds, ws) if compounds is not None else None, fields=fields)
    allowed = None if filters is None else df.where(filters).select(F.col("decision_id").alias("doc"))
    hits = run(index, [(name, parse(q)) for name, q, _ in runs], fields, allowed)
    weight = F.element_at(F.create_map(*(F.lit(x) for name, _, w in runs for x in (name, w))), F.col("name"))
    best = ranked(hits, key=["name"]).where(F.col("rank") <= pool).withColumn("weight", weight)
    fused = best.groupBy("doc").agg(F.sum(F.col("weight") / (RRF_CONSTANT + F.col("rank"))).alias("rrf"), F.countDistinct("name").alias("hits"), F.max("score").alias("bm25"))
    if index.store is not None:  # pool rows a strategy at most, of one id and three numbers
        found = fused.collect()
        fused = df.sparkSession.createDataFrame(found, fused.schema)
        df = index.fetch([r["doc"] for r in found])
    rows = df.join(F.broadcast(fused), df["decision_id"] == fused["doc"]).withColumn("snippet", best_passage("full_text", words_of(query)))
    return rerank(rows, query, language).select("decision_id", "docket_number", "title", "snippet", "relevance_score").limit(limit)


def by_id(df: DataFrame, wanted: str, id_col: str = "decision_id") -> DataFrame:
    """The row of an id; the condition reaches the files."""
    return df.where(F.col(id_col) == wanted)


def best_passage(c, words: list[str], most: int = 300) -> Column:
    """The paragraph with most of the words, the first of equals, cut to a length."""
    parts = F.filter(F.split(text(c), r"\n\s*\n|\n"), lambda p: F.trim(p) != "")
    scored = F.transform(parts, lambda p, i: F.struct(sum((F.array_contains(tokens(p), x).cast("int") for x in words), F.lit(0)).alias("n"), (-i).alias("k"), p.alias("p")))
    return F.substring(F.array_max(scored)["p"], 1, most)


def highlight(c, words: list[str], tag: str = "mark") -> Column:
    return F.regexp_replace(text(c), rf"(?iuU)\b({'|'.join(map(re.escape, words))})\b", rf"<{tag}>$1</{tag}>") if words else text(c)


def interleave(a: DataFrame, b: DataFrame, limit: int, by: str = "score", doc: str = "doc") -> DataFrame:
    """Two ranked lists (doc, score) in turns: first of both, second of both, and so on."""
    both = ranked(a, by, doc=doc).withColumn("corpus", F.lit(0)).unionByName(ranked(b, by, doc=doc).withColumn("corpus", F.lit(1)))
    return both.orderBy("rank", "corpus").limit(limit)


def topic_scores(cases: DataFrame, topic: str, language: str | None = None) -> DataFrame:
    """Scores of a curriculum's cases for a topic; columns area_id, module_id, names, titles, concepts, statutes, actual_language."""
    t, ws = topic.lower(), topic.lower().split()

    def low(c):
        return F.lower(text(c))

    def within(a, b):
        return a.contains(b)

    mod = low("module_id")
    score = F.when(mod == t, 5).when(within(mod, F.lit(t)) | within(F.lit(t), mod), 3).otherwise(0)
    for c in ("title_de", "title_fr", "title_it"):
        score += F.when(within(low(c), F.lit(t)), 3).when(within(F.lit(t), low(c)) & (F.length(low(c)) > 3), 2).otherwise(0)

    def concept(x):
        x = F.lower(x)
        return F.when(within(x, F.lit(t)) | within(F.lit(t), x), 2).when(F.arrays_overlap(F.split(x, r"\s+"), F.array(*map(F.lit, ws or [""]))), 1).otherwise(0)

    for c in ("concepts_de", "concepts_fr", "concepts_it"):
        score += F.aggregate(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), concept), F.lit(0), lambda a, b: a + b)
    score += 2 * F.size(F.filter(F.coalesce(F.col("statutes"), F.array().cast("array<string>")), lambda x: F.lower(x).contains(t)))
    score += F.when(within(low("name_de"), F.lit(t)) | within(low("name_fr"), F.lit(t)), 1).otherwise(0) + F.when(within(text("area_id"), F.lit(t)), 1).otherwise(0)
    if language:
        score += F.when(text("actual_language") == "", 0).when(F.col("actual_language") == language, 2).otherwise(-1)
    return cases.withColumn("score", score)


def find_case(cases: DataFrame, topic: str, difficulty: int | None = None, language: str | None = None, position: str = "position") -> DataFrame:
    """The best case of a topic, those within the difficulty first, earlier ones first among equals; none without a positive score."""
    scored = topic_scores(cases, topic, language).where("score > 0")
    inside = F.lit(0) if difficulty is None else F.when(F.col("difficulty") <= difficulty, 0).otherwise(1)
    return scored.withColumn("_out", inside).orderBy("_out", F.desc("score"), position).limit(1).drop("_out")


def rerank_with(candidates: DataFrame, scorer, top: int = 30, weight: float = 1.4, by: str = "relevance_score", doc: str = "doc") -> DataFrame:
    """The first candidates with a second opinion: scorer(DataFrame) gives (doc, opinion); the others keep their order below.

    Any model can be plugged in; without one nothing changes.
    """
    if scorer is None:
        return candidates
    first = candidates.orderBy(F.desc(by), doc).limit(top)
    opinion = scorer(first).select(doc, "opinion")
    return candidates.join(F.broadcast(opinion), doc, "left").withColumn(by, F.col(by) + weight * F.coalesce("opinion", F.lit(0.0))).drop("opinion").orderBy(F.desc(by), doc)  # top rows
