"""Citation and statute graph: edges, resolution of references, queries."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.references import case_citations, statute_references
from ..functions.text import docket_norm, infer_court, text
from .lineage import checkpointed

REPORT_COURTS = ["bge", "bger", "bge_historical"]
#: Levels of a chain after which the plan is cut.
LEVELS = 16
PASSES = ["docket_norm", "bge_norm", "bge_bare"]


def vertices(df: DataFrame) -> DataFrame:
    return df.select("decision_id", "court", "canton", "language", "decision_date", docket_norm("docket_number").alias("docket_norm"))


def whole_text() -> Column:
    return F.concat_ws("\n", text("title"), text("regeste"), text("full_text"))


def statute_edges(df: DataFrame, body: Column | None = None) -> DataFrame:
    """(decision_id, statute_id, mention_count): how many rows of a decision's id mention the statute."""
    found = df.select("decision_id", F.explode(statute_references(whole_text() if body is None else body)).alias("s"))
    return found.groupBy("decision_id", F.col("s.normalized").alias("statute_id")).agg(F.count("*").alias("mention_count"))


def citation_edges(df: DataFrame, body: Column | None = None, prior: DataFrame | None = None) -> DataFrame:
    """(source_decision_id, target_ref, target_type, mention_count, is_prior); prior: (source_decision_id, target_ref) of earlier instances."""
    found = df.select(F.col("decision_id").alias("source_decision_id"), F.explode(case_citations(whole_text() if body is None else body)).alias("c"))
    rows = found.select("source_decision_id", F.col("c.normalized").alias("target_ref"), F.col("c.kind").alias("target_type"), F.lit(1).alias("n"), F.lit(0).alias("p"))
    if prior is not None:
        rows = rows.unionByName(prior.select("source_decision_id", "target_ref", F.lit("docket").alias("target_type"), F.lit(0).alias("n"), F.lit(1).alias("p")))
    out = rows.groupBy("source_decision_id", "target_ref").agg(F.min("target_type").alias("target_type"), F.greatest(F.sum("n"), F.lit(1)).alias("mention_count"), F.max("p").alias("is_prior"))
    return out


def confidence(rank: Column, count: Column) -> Column:
    """How sure a resolved citation is, from courts, cantons, days and the number of candidates; columns of the source begin with s_, of the target with t_."""

    def present(c):
        return F.coalesce(F.col(c), F.lit("")) != ""

    score = F.lit(0.55)
    score += F.when(F.col("s_inferred").isNotNull() & present("t_court"), F.when(F.col("t_court") == F.col("s_inferred"), 0.20).otherwise(-0.20)).otherwise(0.0)
    score += F.when(present("s_canton") & (F.col("s_canton") == F.col("t_canton")), 0.10).otherwise(0.0)
    score += F.when(present("s_court") & (F.col("s_court") == F.col("t_court")), 0.08).otherwise(0.0)
    days = F.col("s_day") - F.col("t_day")
    score += F.when(days >= 0, 0.15).when(days < 0, -0.15).otherwise(0.0)
    score += F.when(F.abs(days) <= 365, 0.10).when(F.abs(days) <= 3 * 365, 0.05).otherwise(0.0)
    score += F.when(rank == 1, 0.05).when(rank == 2, 0.02).otherwise(0.0)
    score -= F.when(count > 1, F.least(F.lit(0.15), 0.03 * (count - 1))).otherwise(0.0)
    return F.greatest(F.lit(0.05), F.least(F.lit(0.99), F.round(score, 4)))


#: Citations of a key that one task pairs with all candidates, about, and pairs of a task.
PIECE, TASK_PAIRS, MOST_TASKS = 8192, 1_000_000, 4096
KEY = ["kind", "key"]
SOURCE = ["s_court", "s_canton", "s_day", "s_date", "s_inferred"]


class Links:
    """What citations resolve to, kept as both sides of the pairs, as pairs grow with citations times candidates.

    refs (kind, key, source_decision_id, target_ref, mention_count, own, s_...): a row for each citation and each of PASSES (kind) that may
    resolve it; own: the source itself is a candidate. candidates (kind, key, target_decision_id, of, rank, count, t_...): the
    decisions of a key in order; of: the dockets of a decision, so that decisions with the same ones are cited by the same sources.
    What is counted or summed up comes from the sides; only ``pairs`` makes pairs.
    """

    def __init__(self, refs: DataFrame, candidates: DataFrame):
        self.refs, self.candidates = refs, candidates

    @classmethod
    def of(cls, edges: DataFrame, nodes: DataFrame) -> Links:
        """Dockets by their normal form with all candidates; reports with and without their series' name; bare references that are left
        under the series' name. Each is an equality of keys: what would be an OR becomes several keys. Rows that repeat an id are one decision."""
        report, d = F.coalesce(F.col("court").isin(REPORT_COURTS), F.lit(False)), F.col("docket_norm")
        date = F.trim("decision_date")
        day = F.when(date.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.unix_date(date.try_cast("date")))
        row = F.struct("court", "canton", day.alias("day"), F.col("decision_date").alias("date"))
        dockets = F.array_sort(F.collect_set(F.when(d.isNotNull(), F.struct(d.alias("docket"), report.alias("report")))))
        one = nodes.where("decision_id IS NOT NULL").groupBy("decision_id").agg(F.min(row).alias("x"), dockets.alias("of"))

        def entry(kind, key):
            return F.struct(F.lit(kind).alias("kind"), key.alias("key"))

        def keys(o):
            bare = F.when(o["docket"].startswith("BGE "), F.substr(o["docket"], F.lit(5)))
            return F.array(entry(0, o["docket"]), F.when(o["report"], entry(1, o["docket"])), F.when(o["report"] & bare.isNotNull(), entry(1, bare)), F.when(o["report"], entry(2, o["docket"])))

        listed = one.select("decision_id", "x", "of", F.explode(F.array_distinct(F.array_compact(F.flatten(F.transform("of", keys))))).alias("k"))
        w = Window.partitionBy("kind", "key")
        candidates = listed.select("k.kind", "k.key", F.col("decision_id").alias("target_decision_id"), "of", *(F.col(f"x.{c}").alias(f"t_{c}") for c in ("court", "canton", "day", "date")))
        candidates = candidates.withColumn("rank", F.row_number().over(w.orderBy(F.col("t_date").desc_nulls_last(), "target_decision_id"))).withColumn("count", F.count("*").over(w))

        n = F.col("mention_count") if "mention_count" in edges.columns else F.lit(1)
        once = edges.groupBy("source_decision_id", "target_ref", "target_type").agg(F.sum(n).alias("mention_count"))
        source = one.select(F.col("decision_id").alias("source_decision_id"), F.col("of").alias("s_of"), *(F.col(f"x.{c}").alias(f"s_{c}") for c in ("court", "canton", "day", "date")))
        known = listed.where("k.kind = 0").groupBy(F.col("k.key").alias("target_ref")).agg(F.count("*").alias("n"))
        once = once.join(source, "source_decision_id", "left").join(known, "target_ref", "left")
        ref = F.col("target_ref")
        mine = lambda kind, key: F.exists("s_of", lambda o: F.exists(keys(o), lambda k: F.coalesce((k["kind"] == kind) & (k["key"] == key), F.lit(False))))
        docket, left = F.col("target_type") == "docket", F.coalesce("n", F.lit(0)) - F.coalesce(F.exists("s_of", lambda o: o["docket"] == ref), F.lit(False)).cast("int")
        tried = F.array(
            F.when(docket, entry(0, ref)), F.when((F.col("target_type") == "bge") & ref.startswith("BGE "), entry(1, F.substr(ref, F.lit(5)))),
            F.when(docket & ref.rlike(r"(?s)^[0-9].* [IVX].* [0-9].*$") & (left == 0), entry(2, F.concat(F.lit("BGE "), ref))),
        )
        refs = once.withColumn("k", F.explode(F.array_compact(tried))).withColumns({"kind": F.col("k.kind"), "key": F.col("k.key")})
        inferred = F.when(F.col("kind") == 0, infer_court("target_ref"))
        refs = refs.withColumn("own", F.coalesce(mine(F.col("kind"), F.col("key")), F.lit(False))).withColumn("s_inferred", inferred).select(*KEY, "source_decision_id", "target_ref", "mention_count", "own", *SOURCE)
        return cls(refs, candidates)

    def sure(self) -> Column:
        """The confidence of a source and a candidate that meet; the source itself is left out of the order and the number of candidates."""
        ahead = F.coalesce(F.when(F.col("s_date").eqNullSafe(F.col("t_date")), F.col("source_decision_id") < F.col("target_decision_id")).otherwise(F.col("t_date").isNull() | (F.col("s_date") > F.col("t_date"))), F.lit(False))
        docket, own = F.col("kind") == 0, F.col("own")
        rank, count = F.col("rank") - (own & ahead).cast("int"), F.col("count") - own.cast("int")
        return confidence(F.when(docket, rank).otherwise(1), F.when(docket, count).otherwise(1))

    def pairs(self) -> DataFrame:
        """(source_decision_id, target_ref, target_decision_id, match_type, confidence_score): all of them. Both sides are shuffled, pairs are not:
        citations of a key are dealt into pieces, each of which meets all candidates."""
        sizes = self.refs.groupBy(*KEY).agg(F.count("*").alias("_r")).join(self.candidates.groupBy(*KEY).agg(F.count("*").alias("_t")), KEY)
        sizes = checkpointed(sizes.select(*KEY, F.ceil(F.col("_r") / PIECE).cast("int").alias("_pieces"), (F.col("_r") * F.col("_t")).alias("_pairs")))
        tasks = min(MOST_TASKS, 1 + (sizes.agg(F.sum("_pairs")).first()[0] or 0) // TASK_PAIRS)
        sizes = sizes.drop("_pairs")
        piece = F.pmod(F.xxhash64("source_decision_id", "target_ref"), "_pieces").cast("int")
        refs = self.refs.join(sizes, KEY).withColumn("_piece", piece).drop("_pieces").repartition(tasks, *KEY, "_piece")
        targets = self.candidates.drop("of").join(sizes, KEY).withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))).drop("_pieces")
        met = refs.join(targets.hint("shuffle_merge"), [*KEY, "_piece"]).where("target_decision_id <> source_decision_id")
        name = F.element_at(F.array(*map(F.lit, PASSES)), F.col("kind") + 1)
        return met.select("source_decision_id", "target_ref", "target_decision_id", name.alias("match_type"), self.sure().alias("confidence_score"))

    def about(self, decision_id: str) -> DataFrame:
        """The pairs of one decision, both ways."""
        out, into = (Links(self.refs.where(F.col("source_decision_id") == decision_id), self.candidates), Links(self.refs, self.candidates.where(F.col("target_decision_id") == decision_id)))
        return out.pairs().unionByName(into.pairs())

    def resolved(self) -> DataFrame:
        """(source_decision_id, target_ref, links) of citations that resolve."""
        n = self.candidates.groupBy(*KEY).agg(F.count("*").alias("_n"))
        links = self.refs.join(n, KEY).withColumn("links", F.col("_n") - F.col("own").cast("int"))
        return links.where("links > 0").groupBy("source_decision_id", "target_ref").agg(F.sum("links").alias("links"))

    def citations(self) -> DataFrame:
        """(decision_id, citations): by how many others each decision is cited, of those that are. Decisions with the same dockets have the same
        sources, so these are told apart once for all of them."""
        sources = self.refs.select(*KEY, "source_decision_id").join(self.candidates.select(*KEY, "of").distinct(), KEY).select("of", "source_decision_id").distinct()
        own = self.candidates.select(F.col("target_decision_id").alias("decision_id"), "of").distinct()
        self_cited = sources.select("of", F.col("source_decision_id").alias("decision_id"), F.lit(1).alias("_own"))
        counted = own.join(sources.groupBy("of").agg(F.count("*").alias("_n")), "of").join(self_cited, ["of", "decision_id"], "left")
        return counted.select("decision_id", (F.col("_n") - F.coalesce("_own", F.lit(0))).alias("citations")).where("citations > 0")

    def authority(self) -> DataFrame:
        """(decision_id, authority), see ``authority``: sources of a key that are alike in all that confidence looks at are summed up before they meet candidates."""
        alike = F.when(F.col("own"), F.col("source_decision_id")).alias("source_decision_id")
        sums = self.refs.select(*KEY, alike, "own", "mention_count", *SOURCE).groupBy(*KEY, "source_decision_id", "own", *SOURCE).agg(F.sum("mention_count").alias("mention_count"))
        met = sums.join(self.candidates.drop("of"), KEY).where(~F.col("own") | (F.col("target_decision_id") != F.col("source_decision_id")))
        return met.groupBy(F.col("target_decision_id").alias("decision_id")).agg(F.least(F.lit(1.0), 0.03 * F.sum(F.col("mention_count") * self.sure())).alias("authority"))


def resolve(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(source_decision_id, target_ref, target_decision_id, match_type, confidence_score), see ``Links``."""
    return Links.of(edges, nodes).pairs()


def graph_stats(edges: DataFrame, links: Links) -> DataFrame:
    return edges.agg(F.count("*").alias("citations"), F.countDistinct("source_decision_id").alias("citing")).crossJoin(  # one row each
        links.resolved().agg(F.coalesce(F.sum("links"), F.lit(0)).alias("links"), F.count("*").alias("resolved"))
    ).crossJoin(links.citations().agg(F.count("*").alias("cited")))


def resolution_rate(edges: DataFrame, links: Links) -> DataFrame:
    hit = edges.join(links.resolved().withColumn("hit", F.lit(1)), ["source_decision_id", "target_ref"], "left")
    return hit.agg(F.count("*").alias("refs"), F.count("hit").alias("resolved")).withColumn("rate", F.round(F.col("resolved") / F.col("refs"), 4))


def citations_of(edges: DataFrame, targets: DataFrame, decision_id: str, least: float = 0.3, limit: int | None = 200) -> DataFrame:
    """Both directions, each with limit rows at most (None: all); outgoing references that nothing resolves stay with null."""
    ok = targets.where(F.col("confidence_score") >= least)
    out = edges.where(F.col("source_decision_id") == decision_id).join(ok, ["source_decision_id", "target_ref"], "left")
    out = out.select(F.lit("outgoing").alias("direction"), F.col("target_decision_id").alias("other"), "target_ref", "mention_count", "confidence_score")
    into = ok.where(F.col("target_decision_id") == decision_id).join(edges, ["source_decision_id", "target_ref"])
    into = into.select(F.lit("incoming").alias("direction"), F.col("source_decision_id").alias("other"), "target_ref", "mention_count", "confidence_score")
    if limit is None:
        return out.unionByName(into)
    order = [F.col("confidence_score").desc_nulls_last(), F.col("target_ref"), F.col("other")]
    return out.orderBy(*order).limit(limit).unionByName(into.orderBy(*order).limit(limit))


def appeal_chain(prior: DataFrame, start: DataFrame, depth: int | None = None) -> DataFrame:
    """(start, decision_id, distance): earlier instances below zero, later ones above, by the shortest way.

    prior: (decision_id, prior_id). Levels are joined one after another until none is new (with a depth,
    so many at most); a cycle ends where it meets what it has. Rounds grow with the longest chain.
    """
    found = start.select(F.col("decision_id").alias("start"), "decision_id", F.lit(0).alias("distance"))
    for key, other, sign in (("decision_id", "prior_id", -1), ("prior_id", "decision_id", 1)):
        edge = prior.select(F.col(key).alias("decision_id"), F.col(other).alias("_to")).distinct()
        level = checkpointed(start.select(F.col("decision_id").alias("start"), "decision_id").distinct())
        seen = level
        for d in count(1) if depth is None else range(1, depth + 1):
            new = level.join(edge, "decision_id").select("start", F.col("_to").alias("decision_id")).distinct()
            level = checkpointed(new.join(seen, ["start", "decision_id"], "left_anti"))
            if level.isEmpty():
                break
            seen = seen.unionByName(level)
            found = found.unionByName(level.withColumn("distance", F.lit(sign * d)))
            if d % LEVELS == 0:
                seen, found = checkpointed(seen), checkpointed(found)
    return found


def leading_cases(statutes: DataFrame, links: Links, statute_id: str | None = None, limit: int = 8) -> DataFrame:
    """Decisions that mention a statute, the most cited first."""
    mentions = (statutes if statute_id is None else statutes.where(F.col("statute_id") == statute_id)).groupBy("decision_id").agg(F.sum("mention_count").alias("mentions"))
    both = mentions.join(links.citations(), "decision_id", "left").withColumn("citations", F.coalesce("citations", F.lit(0)))
    return both.orderBy(F.desc("citations"), F.desc("mentions"), "decision_id").limit(limit)


def authority(links: Links) -> DataFrame:
    """(decision_id, authority): incoming mentions weighted by how sure they are, 1 at most after scaling."""
    return links.authority()


def case_brief(df: DataFrame, edges: DataFrame, targets: DataFrame, statutes: DataFrame, decision_id: str) -> DataFrame:
    """One row: the decision with its statutes and all its citations both ways."""
    own = df.where(F.col("decision_id") == decision_id)
    s = statutes.where(F.col("decision_id") == decision_id).groupBy("decision_id").agg(F.array_sort(F.collect_set("statute_id")).alias("statutes"))
    c = citations_of(edges, targets, decision_id, limit=None).groupBy("direction").agg(F.array_sort(F.collect_set("other")).alias("ids"))
    both = c.groupBy(F.lit(decision_id).alias("decision_id")).agg(F.first(F.when(F.col("direction") == "incoming", F.col("ids")), True).alias("cited_by"), F.first(F.when(F.col("direction") == "outgoing", F.col("ids")), True).alias("cites"))
    return own.join(s, "decision_id", "left").join(both, "decision_id", "left")


def doctrine_timeline(df: DataFrame, statutes: DataFrame, links: Links, statute_id: str, limit: int = 20) -> DataFrame:
    return leading_cases(statutes, links, statute_id, limit).join(df.select("decision_id", "decision_date", "court", "docket_number"), "decision_id").orderBy(F.col("decision_date").asc_nulls_last(), "decision_id")


def trend(df: DataFrame, matching: DataFrame) -> DataFrame:
    """Matching decisions by year."""
    return df.join(matching.select("decision_id"), "decision_id", "left_semi").withColumn("year", F.substring("decision_date", 1, 4)).where(F.col("year").rlike(r"^\d{4}$")).groupBy("year").agg(F.count("*").alias("n"))
