"""Toxicity of texts after noisy-channel deobfuscation.

Spans that may hide words (digits or signs among letters, letters set apart, letters repeated) become
lattices: every character has the letters it may stand for, separators may vanish or stay word ends,
runs may shrink. A Viterbi search finds the likeliest reading under a character language model and the
costs of the channel. The restored text is then scored: weights of telling words, learned from
labels by their document frequencies, are summed and turned into a probability.

Learned from all labelled rows: ids and hashes of texts meet labels by a join, and the ids and labels of different texts
are broadcast if they are ``most_sent`` or fewer, so no text moves but as word counts (texts of more of them are shuffled). The ``lexicon_size`` most telling words and
the ``vocabulary_size`` most frequent ones (for the character model) are kept and sent to workers, so the
model's size is bounded whatever the input. Every step over a text takes time in proportion to its length.

Defined results: null and empty texts score like a text without telling words; without labels of both
kinds every text scores 0. Copies of a labelled text count once. Whole texts are read. Repeated rows
give repeated results; a row with several labels counts as toxic if one of them says so. Null labels
and null ids teach nothing; an empty table gives no rows. Ties go to the word that sorts first, or to
the reading found first. Other columns are not looked at.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, map_arrow, rows_of

#: Letters that signs and digits are used for, the likeliest first.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
    "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "h", "(": "c", "<": "c", "%": "x", "?": "",
}
SIGNS = "".join(STANDS_FOR)
#: Where a word may be hidden: signs among letters, single characters set apart, runs of a letter.
TOKEN = re.compile(r"[\w@$!|+€£¡*#(<%]+")
MIXED = re.compile(r"[^\W\d_][0-9@$!|+€£¡*#(<%]+[^\W_]|[0-9@$!|+€£¡*#(<][^\W\d_]")
APART = re.compile(r"(?<![^\W_])[^\W_@$](?:[ ._*\-|/]{1,3}[\w@$!](?![^\W_])){2,}")
REPEATED = re.compile(r"([^\W\d_])\1\1")
WORD = re.compile(r"[^\W_]+")
#: Signs that belong to the sentence where they end a span.
AFTER = "!?*#%(<"
SEPARATORS = set(" ._*-|/")
ORDER = 4
#: Log costs of the channel.
AS_SIGN, STAYS, DROPPED, WORD_END, RUN = math.log(0.5), math.log(1e-5), math.log(0.9), math.log(0.05), math.log(0.6)
#: Words a worker remembers before it starts anew, and their length: bounds on its memory only.
REMEMBERED, REMEMBERED_CHARS = 100_000, 100


class CharacterModel:
    """Interpolated character n-grams over words with counts; a space begins and ends a word."""

    def __init__(self, words: dict[str, float]):
        self.counts: list[dict[str, float]] = [{} for _ in range(ORDER + 1)]
        for w, n in words.items():
            s = " " * (ORDER - 1) + w + " "
            for i in range(ORDER - 1, len(s)):
                for k in range(1, ORDER + 1):
                    g = s[i - k + 1 : i + 1]
                    self.counts[k][g] = self.counts[k].get(g, 0.0) + n
        self.context: list[dict[str, float]] = [{} for _ in range(ORDER + 1)]
        self.kinds: list[dict[str, int]] = [{} for _ in range(ORDER + 1)]
        for k in range(1, ORDER + 1):
            for g, n in self.counts[k].items():
                self.context[k][g[:-1]] = self.context[k].get(g[:-1], 0.0) + n
                self.kinds[k][g[:-1]] = self.kinds[k].get(g[:-1], 0) + 1
        self.known: dict[str, float] = {}

    def log(self, context: str, c: str) -> float:
        """Log probability of c after context (its last ORDER - 1 characters)."""
        key = context + c
        if (p := self.known.get(key)) is None:
            p = 1e-4
            for k in range(1, ORDER + 1):
                before = key[-k:-1] if k > 1 else ""
                if n := self.context[k].get(before):
                    t = self.kinds[k][before]
                    p = (self.counts[k].get(key[-k:], 0.0) + t * p) / (n + t)
            p = self.known[key] = math.log(p)
            if len(self.known) > 2 * REMEMBERED:
                self.known.clear()
        return p


def lattice(span: str, apart: bool) -> list[list[tuple[str, float]]]:
    """For each character or run of the span the strings it may stand for, with log costs."""
    out, i = [], 0
    while i < len(span):
        c, j = span[i], i + 1
        while j < len(span) and span[j] == c:
            j += 1
        n, i = j - i, j
        if apart and c in SEPARATORS:
            own = [("", DROPPED), (" ", WORD_END)]
        elif c.isalpha():
            own = [(c * n, 0.0)] if n <= 2 else [(c, RUN), (c * 2, RUN)]
            if n == 2:
                own.append((c, math.log(0.05)))
        elif c in STANDS_FOR:
            own = [(x * min(n, 2), AS_SIGN - 0.5 * k) for k, x in enumerate(STANDS_FOR[c])] + [(c * n, STAYS * n)]
            if n > 1:
                own += [(x, AS_SIGN + RUN - 0.5 * k) for k, x in enumerate(STANDS_FOR[c])]
        else:
            own = [(c * n, STAYS * n)]
        out.append(own)
    return out


def viterbi(lm: CharacterModel, columns: list[list[tuple[str, float]]]) -> str:
    """The likeliest reading of a lattice as a word or words."""
    start = " " * (ORDER - 1)
    states = {start: (0.0, None)}  # context -> (score, (earlier link, output))
    for own in columns:
        new: dict[str, tuple] = {}
        for context, (score, back) in states.items():
            for text, cost in own:
                s, at = score + cost, context
                for c in text:
                    s += lm.log(at, c)
                    at = (at + c)[1 - ORDER :]
                if at not in new or s > new[at][0]:
                    new[at] = (s, (back, text))
        states = new
    _, back = max(((s + lm.log(at, " "), b) for at, (s, b) in states.items()), key=lambda x: x[0])
    parts = []
    while back:
        back, text = back
        parts.append(text)
    return "".join(reversed(parts))


class Restorer:
    def __init__(self, lm: CharacterModel):
        self.lm, self.known = lm, {}

    def read(self, span: str, apart: bool) -> str:
        if (found := self.known.get((span, apart))) is None:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            found = viterbi(self.lm, lattice(span, apart))
            if len(span) <= REMEMBERED_CHARS:
                self.known[span, apart] = found
        return found

    def restore(self, text: str) -> tuple[str, int]:
        """The text in lower case with hidden words restored, and the number of spans that changed."""
        low, changed = text.lower(), 0

        def put(hidden, apart):
            """For whole tokens of a pattern that takes linear time: those that may hide a word are read."""

            def f(m):
                nonlocal changed
                if hidden is not None and not hidden.search(m[0]):
                    return m[0]
                span = m[0].rstrip(AFTER)
                new = self.read(span, apart) + m[0][len(span) :]
                changed += new != m[0]
                return new

            return f

        low = APART.sub(put(None, True), low)
        if any(c in low for c in SIGNS):
            low = TOKEN.sub(put(MIXED, False), low)
        if REPEATED.search(low):
            low = WORD.sub(put(REPEATED, False), low)
        return low, changed


#: Labelled texts that are broadcast, as ids and labels, at most; more of them meet the texts by a shuffle.
MOST_SENT = 2_000_000


def labels_by_id(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(id, y): a label for each id, 1 if one of its rows says so."""
    return labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("y"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", least_g2: float = 15.0, least_weight: float = 2.5, lexicon_size: int = 5000, vocabulary_size: int = 20_000, most_sent: int = MOST_SENT) -> dict:
    """A model from all rows of docs that labels (id, 1: toxic) know: words' weights, the bias, and words for the character model.

    most_sent only says how texts and labels meet, it never changes results."""
    known = labels_by_id(labels, id_col, label_col)
    rows = docs.select(F.col(id_col).alias("id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text")).withColumn("h", F.xxhash64("text"))
    # copies of a text count once, as toxic if one of them is; rows that repeat id and text share that one
    copies = rows.select("h", "id").join(known, "id").groupBy("h", "id").agg(F.count("*").alias("n"), F.max("y").alias("y"))
    once = checkpointed(copies.groupBy("h").agg(F.min(F.struct("id", "n")).alias("x"), F.max("y").alias("y")).select("h", "x.id", "y", (1 / F.col("x.n")).alias("share")))
    totals = once.agg(F.sum("y").alias("t"), F.count("*").alias("n")).first()
    toxic, clean = totals["t"] or 0, (totals["n"] or 0) - (totals["t"] or 0)
    if not toxic or not clean:
        return {"weights": {}, "bias": -1e9, "words": {}}
    texts = rows.join(F.broadcast(once) if totals["n"] <= most_sent else once, ["h", "id"]).select("y", "share", F.array_distinct(F.split("text", r"[^\p{L}\p{N}]+")).alias("words"))
    t, n = F.round(F.sum(F.col("y") * F.col("share"))).cast("long").alias("t"), F.round(F.sum("share")).cast("long").alias("n")
    counts = texts.select("y", "share", F.explode("words").alias("word")).where("word <> ''").groupBy("word").agg(t, n)
    e = F.col("n") * (toxic / (toxic + clean))
    x, c = F.col("t"), F.col("n") - F.col("t")
    log0 = lambda a, b: F.when(a > 0, a * F.log(a / b)).otherwise(0.0)
    g2 = 2 * (log0(x, e) + log0(c, F.col("n") - e))
    counts = checkpointed(counts.where("n > 1").withColumn("g2", g2))
    # telling: beyond chance, and many times likelier in toxic texts; longer texts have more of all words
    weight = F.log((x + 0.5) / (toxic + 1.0)) - F.log((c + 0.5) / (clean + 1.0))
    lexicon = counts.where((F.col("g2") >= least_g2) & (weight >= least_weight)).orderBy(F.desc("g2"), "word").limit(lexicon_size).collect()
    common = counts.orderBy(F.desc("n"), "word").limit(vocabulary_size).collect()
    weights = {r["word"]: math.log((r["t"] + 0.5) / (toxic + 1)) - math.log((r["n"] - r["t"] + 0.5) / (clean + 1)) for r in lexicon}
    untold = texts.where(~F.arrays_overlap("words", F.lit(sorted(weights) or [""]))).agg(t, n).first()
    bias = math.log(((untold["t"] or 0) + 0.5) / ((untold["n"] or 0) - (untold["t"] or 0) + 0.5))
    most = max((r["n"] for r in common), default=1)
    vocabulary = {r["word"]: math.log1p(r["n"]) for r in common if r["word"].isalpha()} | {w: 10 * math.log1p(most) for w in weights if w.isalpha()}
    return {"weights": weights, "bias": bias, "words": vocabulary}


def probability(weights: dict[str, float], bias: float, restored: str) -> float:
    z = bias + sum(weights[w] for w in weights.keys() & set(WORD.findall(restored)))
    return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", restored: bool = True, carry: list[str] | None = None) -> DataFrame:
    """(id, score, n_restored, text, restored, carry) for each row of docs: the score, the number of spans that restoring
    changed, the text as it was and, if asked for, restored in lower case."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        weights, bias = sent.value["weights"], sent.value["bias"]
        restorer = Restorer(CharacterModel(sent.value["words"]))

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            found = [restorer.restore(t or "") for t in b.column(1).to_pylist()]
            scores = [probability(weights, bias, t) for t, _ in found]
            columns = [pa.array(scores, pa.float64()), pa.array([n for _, n in found], pa.int64()), b.column(1)]
            if restored:
                columns.append(pa.array([t for t, _ in found], pa.string()))
            return pa.record_batch(columns, names=["score", "n_restored", "own", "restored"][: len(columns)])

        return f

    return map_arrow(rows_of(docs, id_col, text_col, carry), make, "score double, n_restored long, own string" + ", restored string" * restored).withColumnsRenamed({"id": id_col, "own": text_col})
