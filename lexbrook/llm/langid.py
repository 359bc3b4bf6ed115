"""Language identification by compression.

For each language a raw-content zstandard dictionary is made of labelled text. A text is cut into
blocks, each is compressed with every dictionary behind some text of the language (so that short ones
differ in size, too), and the language whose dictionary gives the smallest total is chosen. Where the
runner-up is nearly as small the result is marked rejected.

Training: a bounded sample of labelled rows, ``docs_per_language`` with the smallest hashes of their
ids and ``piece_chars`` characters from a place in each that the hash chooses; dictionaries hold
``dictionary_bytes`` at most, and all of them together ``total_bytes``. Counts of labels cover all rows.

Defined results: a null text or one without a letter (Unicode category L) is ``und`` with score 0. Ties
go to the language whose name sorts first. Whole texts are compressed, whatever their length, all in the
same way. Null labels and null ids teach nothing; without any label all texts are ``und``; an empty
table gives no rows. Repeated rows give repeated results. Columns other than those named are not
looked at.
"""

from __future__ import annotations

import math

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, rows_of

UNKNOWN = "und"
NOISE = regex.compile(r"[^\p{L}\s]+")
BLOCK_CHARS = 16384
#: Bytes of a language's own text before each block.
PRIME_BYTES = 1500
#: Bytes of all dictionaries, which are sent to every worker.
TOTAL_BYTES = 64 << 20


def letters_only(text: str | None) -> str:
    return NOISE.sub("", text or "").strip().lower()


def train_dictionaries(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    docs_per_language: int = 150, piece_chars: int = 2000, dictionary_bytes: int = 100_000, total_bytes: int = TOTAL_BYTES,
) -> dict[str, bytes]:
    """Language -> dictionary content, from a bounded sample of the labelled rows of docs."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col).cast("string")).alias("h"), F.col(text_col).alias("text")).where(F.col("lang").isNotNull() & F.col(id_col).isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    dictionary_bytes = min(dictionary_bytes, total_bytes // len(counts))
    docs_per_language = max(1, min(docs_per_language, math.ceil(2 * dictionary_bytes / piece_chars)))
    # about four times the sample passes by its hash alone, before rows of a language meet
    share = F.element_at(F.create_map(*(x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, 4.0 * docs_per_language / n))))), F.col("lang"))
    near = rows.where(F.pmod("h", F.lit(1 << 31)) < share * (1 << 31))
    start = F.pmod(F.shiftright("h", 20), F.greatest(F.length("text") - piece_chars, F.lit(1))) + 1
    piece = near.select("lang", "h", F.col("text").substr(start.cast("int"), F.lit(piece_chars)).alias("piece")).where(F.col("piece").rlike(r"\p{L}"))
    first = piece.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "piece"))).where(F.col("k") <= docs_per_language)
    texts: dict[str, list] = {}
    for r in sorted(first.collect(), key=lambda r: (r["lang"], -r["k"])):
        texts.setdefault(r["lang"], []).append(letters_only(r["piece"]))
    return {k: " ".join(x).encode()[-dictionary_bytes - PRIME_BYTES :] for k, x in texts.items()}


def _compressor(dictionary: bytes, level: int):
    d = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=d, level=level, write_content_size=False, write_dict_id=False)


class Classifier:
    """dictionaries: language -> sample text, whose start goes before each block and whose rest is the dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], level: int):
        self.langs = sorted(dictionaries)
        cut = {k: min(PRIME_BYTES, len(v) // 4) for k, v in dictionaries.items()}
        self.made = [_compressor(dictionaries[k][cut[k] :], level) for k in self.langs]
        self.primes = [dictionaries[k][: cut[k]] for k in self.langs]
        self.primed = [len(c.compress(p)) for c, p in zip(self.made, self.primes)]

    def sizes(self, text: str | None) -> list[int] | None:
        """Compressed bytes by language, 1 at least; None if there is nothing to go by."""
        clean = letters_only(text)
        if not clean or not self.langs:
            return None
        found = [0] * len(self.langs)
        for i in range(0, len(clean), BLOCK_CHARS):
            raw = b" " + clean[i : i + BLOCK_CHARS].encode("utf-8", "replace")
            for k, (c, p, n) in enumerate(zip(self.made, self.primes, self.primed)):
                found[k] += len(c.compress(p + raw)) - n
        return [x + max(0, 1 - min(found)) for x in found]


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", min_margin: float = 0.02, level: int = 5) -> DataFrame:
    """(id, lang, score, margin, rejected) for each row of docs.

    margin: how much smaller the best is than the runner-up, as a share; rejected: margin < min_margin;
    score: the runner-up's share of both sizes (half of 1 at a tie, 1 if there is no runner-up).
    """
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def make():
        model = Classifier(sent.value, level)

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            lang, score, margin = [], [], []
            for t in b.column(1).to_pylist():
                if (sizes := model.sizes(t)) is None:
                    lang.append(UNKNOWN), score.append(0.0), margin.append(0.0)
                    continue
                k = min(range(len(sizes)), key=sizes.__getitem__)
                second = min((s for i, s in enumerate(sizes) if i != k), default=None)
                m = 1.0 if second is None else (second - sizes[k]) / second
                lang.append(model.langs[k]), margin.append(m), score.append(1 / (2 - m) if m < 1 else 1.0)
            rejected = [m < min_margin for m in margin]
            return pa.record_batch([pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64()), pa.array(rejected, pa.bool_())], names=["lang", "score", "margin", "rejected"])

        return f

    return map_arrow(rows_of(docs, id_col, text_col), make, "lang string, score double, margin double, rejected boolean").withColumnRenamed("id", id_col)
