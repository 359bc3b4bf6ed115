"""Text of HTML by a parser: what scripts, styles, navigation, headers and footers hold is left out."""

from __future__ import annotations

import ctypes
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

#: Elements whose text is left out.
LEFT_OUT = frozenset(["script", "style", "nav", "header", "footer", "noscript"])


class _Lines(HTMLParser):
    """Pieces of text between tags; an element that is left out counts until it ends, or to the end of the page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.inside: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in LEFT_OUT:
            self.inside.append(tag)

    def handle_endtag(self, tag):
        if tag in self.inside:
            while self.inside.pop() != tag:
                pass

    def handle_data(self, data):
        if not self.inside:
            self.pieces.append(data)


def page_text(page: str | None) -> str:
    """The lines of a page that are not blank, without white space at their ends; '' for null."""
    p = _Lines()
    p.feed(page or "")
    p.close()
    return "\n".join(x for piece in p.pieces for line in piece.split("\n") if (x := line.strip()))


#: Bytes of texts that a parser has as Python's own at a time, or one longer text.
PIECE = 1 << 20


def in_pieces(texts: pa.Array, parse, kind: pa.DataType) -> pa.Array:
    """parse(list of texts) of a batch's texts, some at a time: what a worker holds beside the batch and its result does not grow with the batch, and
    is given back, as workers stay alive."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // PIECE)) + 1 if len(sizes) else []
    out = [parse(texts.slice(a, b - a).to_pylist()) for a, b in zip([0, *cuts], [*cuts, len(texts)])]
    found = pa.concat_arrays(out) if len(out) > 1 else out[0] if out else pa.array([], kind)
    del out
    pa.default_memory_pool().release_unused()
    if len(cuts) and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):  # where the C library has it
        trim(0)
    return found


def text_of(column):
    """``page_text`` of a column, in Arrow batches."""

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return in_pieces(pages, lambda some: pa.array([page_text(x) for x in some], pa.string()), pa.string())

    return run(column)
