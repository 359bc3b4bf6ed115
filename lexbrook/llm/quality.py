"""Quality by gradient-boosted trees over document statistics.

A text becomes a row of statistics (``STATISTICS``): lengths, shares of kinds of characters, repetition of words, pairs
of words and lines, and how well it compresses. Trees of a fixed depth are grown on histograms: a statistic's values are put
in at most ``BINS`` bins, and a split is chosen from sums of gradients a bin. The ensemble is flattened into three
arrays of (trees, nodes), and all rows of a batch walk down all trees together, one array step a level.

Fitting takes the statistics (never the texts) of at most ``MOST_LABELS`` labelled ids, chosen by hash, to the driver: 60,000
rows of some twenty numbers. Texts that have equal statistics count once, with their mean label, so a group of
copies weighs as one. Scoring is one scan of the documents without a shuffle.

Results for odd rows: null is the empty text; every text has statistics and a score. Rows with a null id or without a label
teach nothing. With labels of one kind only all scores are their share, without labels 0.5. Equal texts have equal
scores, every row stays, an empty table gives no rows. Other columns are not looked at and can be carried along.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, map_arrow, rows_of
from .toxicity import labels_by_id

MOST_LABELS, BINS = 60_000, 64
STATISTICS = (
    "log_chars log_words word_length short_words long_words lettered_words plain_endings upper digits symbols rare_symbols marks distinct distinct_adjusted "
    "top_word repeated_pairs neighbours_equal log_lines repeated_lines line_words ended_lines sentence_words compressed entropy longest_run"
).split()
#: Classes of bytes.
UPPER, LETTERS, DIGITS = (np.array([chr(b).isupper() for b in range(128)] + [False] * 128), np.array([chr(b).isalpha() for b in range(128)] + [True] * 128), np.array([48 <= b <= 57 for b in range(256)]))
SPACES, MARKS = np.array([b in b" \t\n\r\v\f" for b in range(256)]), np.array([b in b".,;:!?'\"()-" for b in range(256)])
SYMBOLS = ~(LETTERS | DIGITS | SPACES)
ENDINGS = frozenset(".,;:!?)\"'")


def statistics(text: str) -> list[float]:
    """The numbers of STATISTICS for one text, all finite."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(data, minlength=256)
    n = max(1, len(data))
    words = text.split()
    m = max(1, len(words))
    counts, pairs = Counter(words), Counter(zip(words, words[1:], strict=False))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = Counter(w[-1] for w in words)
    lines = [x.strip() for x in text.split("\n")]
    lines = [x for x in lines if x]
    seen = Counter(lines)
    letters, spread = max(1, int(kinds[LETTERS].sum())), kinds[kinds > 0] / n
    turns = np.flatnonzero(np.diff(data)) + 1
    run = int(np.diff(np.r_[0, turns, len(data)]).max()) if len(data) else 0
    size = len(zstandard.compress(data.tobytes(), 1)) if len(data) else 0
    sentences = max(1, int(kinds[[33, 46, 63]].sum()))
    return [
        math.log1p(len(text)), math.log1p(len(words)), float(lengths.sum()) / m, float((lengths <= 3).sum()) / m, float((lengths > 12).sum()) / m,
        sum(c for w, c in counts.items() if w[0].isalpha() or w[-1].isalpha()) / m, sum(c for e, c in ends.items() if e.isalpha() or e in ENDINGS) / m,
        int(kinds[UPPER].sum()) / letters, int(kinds[DIGITS].sum()) / n, int(kinds[SYMBOLS].sum()) / n, int(kinds[SYMBOLS & ~MARKS].sum()) / n, int(kinds[MARKS].sum()) / m,
        len(counts) / m, len(counts) / math.sqrt(m), max(counts.values(), default=0) / m, 1 - len(pairs) / max(1, len(words) - 1) if len(words) > 1 else 0.0,
        sum(c for (a, b), c in pairs.items() if a == b) / m, math.log1p(len(lines)), sum(len(x) * (c - 1) for x, c in seen.items()) / max(1, len(text)), m / max(1, len(lines)),
        sum(x[-1] in ".!?" for x in lines) / max(1, len(lines)), m / sentences, size / n, float(-(spread * np.log2(spread)).sum()) if len(data) else 0.0, math.log1p(run),
    ]


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, least: float = 3.0, ridge: float = 1.0) -> dict:
    """An ensemble {base, feature, threshold, value} from rows x with labels y in 0 .. 1.

    Nodes of a tree are numbered by level, those under node i are 2i + 1 (x <= threshold) and 2i + 2; a node
    that is not split sends all rows to the left.
    """
    share = float((y * weight).sum() / weight.sum()) if len(y) else 0.5
    inner = 2**depth - 1
    model = {"base": math.log((share + 1e-6) / (1 - share + 1e-6)), "depth": depth, "feature": np.zeros((0, inner), np.int32), "threshold": np.zeros((0, inner)), "value": np.zeros((0, inner + 1))}
    if not len(y) or share in (0.0, 1.0):
        return model
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T, strict=True)], 1)
    features, flat = x.shape[1], binned + np.arange(x.shape[1]) * BINS
    z, made = np.full(len(y), model["base"]), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = (p - y) * weight, np.maximum(p * (1 - p), 1e-9) * weight
        node, feature, threshold = np.zeros(len(y), np.int64), np.zeros(inner, np.int32), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (features * BINS) + flat).ravel()
            sums = [np.bincount(at, np.repeat(v, features), width * features * BINS).reshape(width, features, BINS).cumsum(2) for v in (g, h)]
            (gl, hl), (gt, ht) = sums, (s[:, :, -1:] for s in sums)
            gr, hr = gt - gl, ht - hl
            gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - gt**2 / (ht + ridge)
            gain[(hl < least * 0.1) | (hr < least * 0.1)] = 0.0
            best = gain.reshape(width, -1).argmax(1)
            for k in range(width):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-3 and b < len(edges[f]):
                    feature[first + k], threshold[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        z += value[leaf]
        made.append((feature, threshold, value))
    model["feature"], model["threshold"], model["value"] = (np.stack(part) for part in zip(*made, strict=True))
    return model


def probabilities(model: dict, x: np.ndarray) -> np.ndarray:
    """Score of each row of x: all rows walk down all trees, one level at a time."""
    trees = np.arange(len(model["feature"]))[None, :]
    node = np.zeros((len(x), trees.shape[1]), np.int64)
    rows = np.arange(len(x))[:, None]
    for _ in range(model["depth"]):
        node = 2 * node + 1 + (x[rows, model["feature"][trees, node]] > model["threshold"][trees, node])
    z = model["base"] + model["value"][trees, node - (2 ** model["depth"] - 1)].sum(1)
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def measured(docs: DataFrame, id_col: str, text_col: str, carry: list[str] | None = None) -> DataFrame:
    """(id, stats, carry): the statistics of each row's text."""

    def make():
        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            return pa.record_batch([pa.array([statistics(t or "") for t in b.column(1).to_pylist()], pa.list_(pa.float64()))], names=["stats"])

        return f

    return map_arrow(rows_of(docs, id_col, text_col, carry), make, "stats array<double>")


def sample_of_labels(labels: DataFrame, id_col: str, label_col: str, most: int) -> DataFrame:
    """(id, y): a label for each id, of at most so many ids, chosen by hash."""
    y = labels_by_id(labels, id_col, label_col)
    n = y.count()
    h = F.pmod(F.xxhash64("id"), F.lit(1 << 31))
    if n > most:  # nearly all that is too much goes before rows meet
        y = y.where(h < (1 << 31) * min(1.0, 1.2 * most / n))
    return checkpointed(y.orderBy(h, "id").limit(most))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_labels: int = MOST_LABELS, **growth) -> dict:
    """An ensemble from the rows of docs that labels (id, 1: good) know."""
    known = F.broadcast(sample_of_labels(labels, id_col, label_col, most_labels).select(F.col("id").alias("known_id"), "y"))  # most_labels rows of two numbers
    own = docs.select(F.col(id_col).alias("known_id"), F.col(text_col).alias("text"))
    texts = own.join(known, "known_id").select("known_id", "text", "y").dropDuplicates(["known_id", "text"])
    found = measured(texts, "known_id", "text", ["y"]).select("stats", F.col("carry.y").alias("y")).toArrow()
    x = np.array(found["stats"].to_pylist(), float).reshape(-1, len(STATISTICS))
    x, at, n = np.unique(x, axis=0, return_inverse=True, return_counts=True)
    y = np.bincount(at.ravel(), np.array(found["y"].to_pylist(), float), len(x)) / np.maximum(1, n)
    return grow(x, y, np.ones(len(y)), **growth)


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(id, score, stats, text, carry) for each row of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            x = [statistics(t or "") for t in b.column(1).to_pylist()]
            scores = probabilities(sent.value, np.array(x, float).reshape(-1, len(STATISTICS)))
            return pa.record_batch([pa.array(scores), pa.array(x, pa.list_(pa.float64())), b.column(1)], names=["score", "stats", "own"])

        return f

    found = map_arrow(rows_of(docs, id_col, text_col, carry), make, "score double, stats array<double>, own string")
    return found.withColumnsRenamed({"id": id_col, "own": text_col})
