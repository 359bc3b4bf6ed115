"""Byte-level BPE encoding and decoding by speculate and verify.

A word is first cut greedily into the longest tokens. A sequence of tokens is what merging by rank
would give if and only if each adjacent pair is what merging would give for the pair alone, so all
adjacent pairs of a batch are tested at once with numpy, walking both tokens back through their
merges. Only words with a failing pair go through exact merging.

Defined results: a null or empty text has no tokens and decodes to ''. Strings of added tokens
(such as ``<|endoftext|>``) inside a text become their id, as the tokenizers library does. Any
text is processed whole. Repeated rows give repeated results; an empty table gives no rows. Of equal
ranks the leftmost pair is merged first. Columns other than the id, the text and those carried are not
looked at.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, rows_of

#: How byte-level BPE cuts a text into words, and which character stands for a byte.
WORDS = r"'(?:s|t|re|ve|m|ll|d)| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
LATIN_SPACES = r"\t-\r \x85\xa0"
SPACES = LATIN_SPACES + r"\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Words whose tokens a worker remembers before it starts anew: a bound on its memory only.
REMEMBERED = 120_000
#: Words of more bytes are merged with a heap and not remembered.
LONG_WORD = 1000
#: The rank of a pair that no merge joins.
NEVER = np.iinfo(np.int64).max
#: A vocabulary file larger than this is refused: it is sent to every worker.
MAX_VOCABULARY_BYTES = 64 << 20


def byte_of_char() -> dict[str, int]:
    out = {chr(b): b for b in SHOWN}
    for b in (b for b in range(256) if b not in set(SHOWN)):
        out[chr(256 + len(out) - len(SHOWN))] = b
    return out


def word_pattern(last: int = sys.maxunicode) -> re.Pattern:
    """WORDS with the code points of letters and numbers, as far as the last one, written out for re."""
    ranges: dict[str, list[list[int]]] = {"L": [], "N": []}
    for i in range(last + 1):
        if (of := ranges.get(unicodedata.category(chr(i))[0])) is not None:
            if of and of[-1][1] == i - 1:
                of[-1][1] = i
            else:
                of.append([i, i])
    classes = {k: "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in of) for k, of in ranges.items()} | {"S": SPACES if last > 255 else LATIN_SPACES}
    return re.compile(re.sub(r"\{([LNS])\}", lambda m: classes[m[1]], WORDS))


@dataclass
class Vocabulary:
    """Tokens as bytes, and for each the two tokens that it is merged from."""

    token: dict[int, bytes]
    id_of: dict[bytes, int]
    left: np.ndarray
    right: np.ndarray
    rank: np.ndarray
    added: dict[str, int]

    @classmethod
    def of(cls, raw: bytes) -> Vocabulary:
        spec = json.loads(raw)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer") or model.get("ignore_merges"):
            raise ValueError("only byte-level BPE without normalizer and prefix space is supported")
        char = byte_of_char()
        id_of = {bytes(char[c] for c in t): i for t, i in model["vocab"].items()}
        n = max(id_of.values()) + 1
        left, right, rank = np.full(n, -1, np.int64), np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        for r, pair in enumerate(model["merges"]):
            a, b = (bytes(char[c] for c in x) for x in (pair if isinstance(pair, list) else pair.split(" ")))
            if rank[i := id_of[a + b]] < 0:
                left[i], right[i], rank[i] = id_of[a], id_of[b], r
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take in white space are not supported")
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        token = {i: t for t, i in id_of.items()} | {i: t.encode() for t, i in added.items()}
        return cls(token, id_of, left, right, rank, added)


class Codec:
    """Encodes and decodes texts with one vocabulary; holds what it has learned about words."""

    def __init__(self, raw: bytes):
        self.v = v = Vocabulary.of(raw)
        merged = np.flatnonzero(v.rank >= 0)
        n = len(v.rank)
        keys = v.left[merged] * n + v.right[merged]
        order = np.argsort(keys)
        self.pair_keys, self.pair_rank, self.n = keys[order], v.rank[merged][order], n
        self.rank_of = dict(zip(self.pair_keys.tolist(), self.pair_rank.tolist()))
        self.merged = np.zeros(int(v.rank.max()) + 2, np.int64)
        self.merged[v.rank[merged]] = merged
        if any(bytes([b]) not in v.id_of for b in range(256)):
            raise ValueError("the vocabulary lacks a byte")
        self.byte_ids = np.array([v.id_of[bytes([b])] for b in range(256)], np.int64)
        self.longest: dict[bytes, int] = {}  # by the first three bytes
        for t in v.id_of:
            self.longest[t[:3]] = max(self.longest.get(t[:3], 0), len(t))
        self.words, self.latin_words = word_pattern(), word_pattern(255)  # the second one is much quicker
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(v.added, key=len, reverse=True))) + ")") if v.added else None
        self.known: dict[str, bytes] = {}
        self.tokens = [v.token.get(i, b"") for i in range(max(v.token) + 1)]
        self.speculated = self.failed = 0

    def cut(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.words.findall(text)
        return self.latin_words.findall(text)

    def greedy(self, word: bytes) -> list[int]:
        if (whole := self.v.id_of.get(word)) is not None:
            return [whole]
        out, i, n, get, longest = [], 0, len(word), self.v.id_of.get, self.longest.get
        while i < n:
            j = min(n, i + longest(word[i : i + 3], 2))
            while (t := get(word[i:j])) is None:
                j -= 1
            out.append(t)
            i = j
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging by rank leaves a|b cut just there, for all pairs at once.

        While the two tokens are built, the side made last is undone first; a merge across the
        cut spoils the pair if it ranks before the step that is undone.
        """
        v = self.v
        ok = np.ones(len(a), bool)
        at = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), NEVER)  # merges of a rank below it come before
        while len(at):
            bad = self.ranks(a, b) < limit
            ok[at[bad]] = False
            ra, rb = v.rank[a], v.rank[b]
            go = ~bad & ((ra >= 0) | (rb >= 0))
            at, a, b, ra, rb = at[go], a[go], b[go], ra[go], rb[go]
            undo_a = ra > rb  # of two equal merges the left one is made first, so the right is undone first
            limit = np.where(undo_a, ra, rb + 1)
            a, b = np.where(undo_a, v.right[a], a), np.where(undo_a, b, v.left[b])
        return ok

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.n + b
        k = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[k] == key, self.pair_rank[k], NEVER)

    def exact(self, words: list[bytes]) -> list[np.ndarray]:
        """Merging by rank, one step in all words at a time: in each word the pair of least rank,
        at all its places from the left."""
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        of = np.repeat(np.arange(len(words)), [len(w) for w in words])
        done: list = [None] * len(words)
        while len(ids):
            rank = np.full(len(ids), NEVER)  # of each token with the next one of its word
            rank[:-1] = np.where(of[:-1] == of[1:], self.ranks(ids[:-1], ids[1:]), NEVER)
            starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            sizes = np.diff(np.r_[starts, len(ids)])
            least = np.minimum.reduceat(rank, starts)
            for k in np.flatnonzero(least == NEVER):
                done[of[starts[k]]] = ids[starts[k] : starts[k] + sizes[k]]
            here = (rank == np.repeat(least, sizes)) & (rank != NEVER)
            at = np.flatnonzero(here)
            new_run = np.r_[True, (np.diff(at) > 1) | (of[at[1:]] != of[at[:-1]])] if len(at) else np.zeros(0, bool)
            at = at[(at - at[new_run][np.cumsum(new_run) - 1]) % 2 == 0]  # of overlapping places every second one
            ids[at] = self.merged[rank[at]]
            keep = np.repeat(least != NEVER, sizes)
            keep[at + 1] = False
            ids, of = ids[keep], of[keep]
        return done

    def exact_long(self, word: bytes) -> np.ndarray:
        """Merging by rank of one word, in time that grows little faster than its length: a heap holds the pairs by rank and place."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        rank_of = self.rank_of
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := rank_of.get(a * self.n + b)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # one of the two is merged by now
            ids[i], ids[j] = int(self.merged[r]), -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (s := rank_of.get(ids[i] * self.n + ids[k])) is not None:
                    heapq.heappush(heap, (s, i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (s := rank_of.get(ids[h] * self.n + ids[i])) is not None:
                heapq.heappush(heap, (s, h, ids[h], ids[i]))
        return np.array([t for t in ids if t >= 0], np.int64)

    def learn(self, words: list[str]) -> None:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        cut = [self.greedy(w) for w in raw]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = np.fromiter((t for ids in cut for t in ids), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(cut)), sizes)
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        pairs, back = np.unique(flat[inside] * self.n + flat[inside + 1], return_inverse=True)
        bad = np.unique(owner[inside[~self.compatible(pairs // self.n, pairs % self.n)[back]]]).tolist()
        self.speculated += len(words)
        self.failed += len(bad)
        short = [i for i in bad if len(raw[i]) <= LONG_WORD]
        for i, ids in zip(short, self.exact([raw[i] for i in short])):
            cut[i] = ids
        for i in bad:
            if len(raw[i]) > LONG_WORD:
                cut[i] = self.exact_long(raw[i])
        flat = np.concatenate(cut).astype(np.int32).tobytes() if cut else b""
        ends = (4 * np.cumsum([0, *map(len, cut)])).tolist()
        for i, w in enumerate(words):
            self.known[w] = flat[ends[i] : ends[i + 1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as the bytes of int32 values."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        plain, parts = [], []
        for t in texts:
            some = self.split.split(t) if self.split and any(s in t for s in self.v.added) else [t]
            own = []
            for k, x in enumerate(some):
                if k % 2:
                    own.append(np.array([self.v.added[x]], np.int32).tobytes())
                else:
                    own.append(ws := self.cut(x))
                    plain.append(ws)
            parts.append(own)
        new = set()
        for ws in plain:
            new.update(ws)
        if new := [w for w in new if w not in self.known]:
            self.learn(new)
        known = self.known
        coded = [b"".join([x if isinstance(x, bytes) else b"".join([known[w] for w in x]) for x in own]) for own in parts]
        for w in new:
            if len(w) > LONG_WORD:
                del known[w]
        return coded

    def decode(self, ids: list[int]) -> str:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids]).decode("utf-8", "replace")


_CODECS: dict[int, Codec] = {}


def _codec(sent) -> Codec:
    """A worker keeps the codec of the vocabulary that it was sent last."""
    if (key := hash(sent.value)) not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(sent.value)
    return _CODECS[key]


def _send(df: DataFrame, tokenizer: str):
    with open(tokenizer, "rb") as f:
        raw = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(raw) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"the vocabulary file is larger than {MAX_VOCABULARY_BYTES} bytes")
    return df.sparkSession.sparkContext.broadcast(raw)


def bpe_encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False, carry: list[str] | None = None) -> DataFrame:
    """(id, ids array<int>, carry) for each row of docs; tokenizer: a file of the tokenizers library on the driver.

    decoded: also ``decoded``, the text that the ids stand for, by the same worker, so that ids need not
    travel twice.
    """
    sent = _send(docs, tokenizer)

    def make():
        codec = _codec(sent)

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            coded = codec.encode([t or "" for t in b.column(1).to_pylist()])
            ends = np.cumsum([0, *(len(x) // 4 for x in coded)]).astype(np.int32)
            columns = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), np.int32)))]
            if decoded:
                columns.append(pa.array([codec.decode(np.frombuffer(x, np.int32).tolist()) for x in coded], pa.string()))
            return pa.record_batch(columns, names=["ids", "decoded"][: len(columns)])

        return f

    return map_arrow(rows_of(docs, id_col, text_col, carry), make, "ids array<int>" + ", decoded string" * decoded).withColumnRenamed("id", id_col)


def bpe_decode(coded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, text): what the ids stand for; null ids give ''."""
    sent = _send(coded, tokenizer)

    def run(batches):
        codec = _codec(sent)
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b = whole.slice(k, 500)
                ids = b.column(1).flatten().to_numpy(zero_copy_only=False).tolist()
                ends = np.cumsum([0, *pc.fill_null(pc.list_value_length(b.column(1)), 0).to_pylist()]).tolist()
                texts = [codec.decode(ids[i:j]) for i, j in zip(ends, ends[1:])]
                yield pa.record_batch([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["id", "ids", "text"])

    rows = coded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>, text string").withColumnsRenamed({"id": id_col, "ids": ids_col})
