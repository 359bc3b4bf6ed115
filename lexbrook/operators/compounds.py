"""Compounds cut into the words that they are made of, by the frequencies of the corpus.

Of all ways to cut a word into two to ``MOST_PARTS`` known words, with a linking letter or two between them, the one with the highest
geometric mean of frequencies is taken, if that is higher than the word's own frequency. All words are cut at once:
their pieces meet the known words by a join, and the best way through a word's pieces is found by
dynamic programming over places, in expressions. The table is made once, beside an index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What German puts between the parts of a compound.
LINKS = ("", "s", "es", "n", "en", "er", "e")
LEAST_PART, LEAST_WORD, MOST_WORD, MOST_PARTS, LEAST_DF = 4, 8, 40, 3, 2


def splits(words: DataFrame, least_df: int = LEAST_DF) -> DataFrame:
    """(term, parts) for each word of (term, df) that is a compound. Parts have at least LEAST_PART letters and are in at least ``least_df`` documents.

    Words of more than MOST_WORD letters are names of nothing and are not cut. Of equal means the parts that come later in the alphabet are taken.
    """
    known = words.where((F.length("term") >= LEAST_PART) & (F.col("df") >= least_df)).select(F.col("term").alias("part"), F.log(F.col("df").cast("double")).alias("weight"))
    long = words.where(F.length("term").between(LEAST_WORD, MOST_WORD) & F.col("term").rlike(r"^\p{L}+$")).select("term", F.log(F.col("df").cast("double")).alias("own"))
    n = F.length("term")
    starts = long.select("term", "own", F.explode(F.sequence(F.lit(0), n - LEAST_PART)).alias("start")).where((F.col("start") == 0) | (F.col("start") >= LEAST_PART))
    pieces = starts.select("*", F.explode(F.sequence(F.lit(LEAST_PART), n - F.col("start"))).alias("size")).where(F.col("size") < n)
    end = F.col("start") + F.col("size")
    pieces = pieces.where((end == n) | (end <= n - LEAST_PART)).select("term", "own", "start", end.alias("end"), F.substring("term", F.col("start") + 1, F.col("size")).alias("part"))
    met = pieces.join(known, "part")
    links = F.filter(F.array(*map(F.lit, LINKS)), lambda x: F.when(F.col("end") == n, x == "").otherwise(F.substring("term", F.col("end") + 1, F.length(x)) == x))
    steps = met.select("term", "own", F.explode(links).alias("link"), "start", "end", "part", "weight")
    steps = steps.groupBy("term", "own").agg(F.collect_list(F.struct("start", (F.col("end") + F.length("link")).alias("next"), "part", "weight")).alias("steps"))
    # of the ways of k parts to a place only the best goes on
    level = "transform(filter(steps, p -> p.start = 0), p -> named_struct('at', p.next, 'score', p.weight, 'parts', array(p.part)))"
    out = []
    for k in range(1, MOST_PARTS + 1):
        best = f"transform(array_distinct(transform({level}, s -> s.at)), a -> array_max(transform(filter({level}, s -> s.at = a), s -> named_struct('score', round(s.score, 9), 'parts', s.parts, 'at', s.at))))"
        steps = steps.withColumn(f"l{k}", F.expr(best))
        if k > 1:
            out.append(F.expr(f"transform(filter(l{k}, s -> s.at = length(term)), s -> named_struct('mean', round(s.score / {k}, 9), 'parts', s.parts))"))
        level = f"flatten(transform(l{k}, s -> transform(filter(steps, p -> p.start = s.at), p -> named_struct('at', p.next, 'score', s.score + p.weight, 'parts', concat(s.parts, array(p.part))))))"
    found = steps.select("term", "own", F.array_max(F.concat(*out)).alias("best"))
    return found.where(F.col("best.mean") > F.round("own", 9)).select("term", F.col("best.parts").alias("parts"))


def oracle(words: str, least_df: int = LEAST_DF) -> str:
    """SQL for (term, parts) over a query of (term, df): all ways through a word."""
    links = ", ".join(f"('{x}')" for x in LINKS)
    return f"""WITH RECURSIVE w AS ({words}), known AS (SELECT term AS part, ln(df::DOUBLE) AS weight FROM w WHERE length(term) >= {LEAST_PART} AND df >= {least_df}),
    l AS (SELECT term, ln(df::DOUBLE) AS own, length(term) AS n FROM w WHERE length(term) BETWEEN {LEAST_WORD} AND {MOST_WORD} AND regexp_full_match(term, '\\p{{L}}+')),
    p AS (SELECT term, own, n, a, unnest(range(a + {LEAST_PART}, n + 1)) AS e FROM (SELECT *, unnest(range(0, n - {LEAST_PART} + 1)) AS a FROM l)),
    s AS (SELECT DISTINCT term, a, e + length(x) AS nx, part, weight, n FROM p JOIN known ON part = substring(term, a + 1, e - a), (VALUES {links}) t(x)
        WHERE e - a < n AND ((e = n AND x = '') OR (e <= n - {LEAST_PART} AND substring(term, e + 1, length(x)) = x))),
    r AS (SELECT term, nx, n, 1 AS k, round(weight, 9) AS score, [part] AS parts FROM s WHERE a = 0
        UNION ALL SELECT r.term, s.nx, r.n, k + 1, round(score + weight, 9), list_append(parts, part) FROM r JOIN s ON s.term = r.term AND s.a = r.nx WHERE k < {MOST_PARTS}),
    f AS (SELECT term, parts, round(score / k, 9) AS mean, row_number() OVER (PARTITION BY term ORDER BY round(score / k, 9) DESC, parts DESC) AS o FROM r WHERE nx = n AND k > 1)
    SELECT f.term, array_to_string(parts, '+') AS parts FROM f JOIN l USING (term) WHERE o = 1 AND mean > round(own, 9)"""


def of_words(table: DataFrame, words: list[str]) -> dict[str, list[str]]:
    """The parts of some words that the table (term, parts) knows; a row a word at most."""
    return {r["term"]: list(r["parts"]) for r in table.where(F.col("term").isin(list(words))).collect()} if words else {}
