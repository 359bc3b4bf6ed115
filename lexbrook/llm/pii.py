"""Format-preserving pseudonyms for personal data.

Numbers and dates are found by their written form and validated (Luhn, mod 97, calendar, octets,
area codes); each is then mapped by a keyed Feistel network, with cycle walking, to another value of
the same form. The map is a permutation for each kind, so equal values get equal pseudonyms in all
documents, different values different ones, and the holder of the key can turn it back. Punctuation,
grouping and check digits keep their form: a valid card number becomes another valid one.

Kinds: ``email`` (letters and digits of the local part), ``iban``, ``ssn``, ``date``, ``ipv4``, ``phone``,
``card`` (13 to 19 digits, Luhn valid), ``account`` (13 to 19 digits that are no card number).

Defined results: null text stays null without spans; empty text stays empty. Overlapping finds are
taken from the left, the kinds in the order above. Texts are read whole. Repeated rows and values give
equal results; an empty table gives no rows. Spans count code points of the original text. Columns
other than those named or carried are not looked at.

A key is needed. Whoever holds it can turn pseudonyms back, so none is built in: ``session_key`` takes
``lexbrook.pii.key`` from the session or, where that is unset, a random one that ends with the application.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import secrets

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import map_arrow, rows_of

ROUNDS = 8
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
#: Values a worker remembers before it starts anew: a bound on its memory only.
REMEMBERED = 200_000
KINDS = ("email", "iban", "ssn", "date", "ipv4", "phone", "card", "account")
FOUND = re.compile(
    r"""(?P<email>(?<![\w.+-])[\w.+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+)
    |(?<![\w.@-])(?:
     (?P<iban>[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?)(?!\w)
    |(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])
    |(?P<ymd>\d{4}([-/.])\d{1,2}\5\d{1,2})(?:(?=[Tt]\d{2}:)|(?![\w-]))
    |(?P<dmy>\d{1,2}([-/.])\d{1,2}\7\d{4})(?![\w-])
    |(?P<ipv4>\d{1,3}(?:\.\d{1,3}){3})(?!\w|\.\d)
    |(?P<number>\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?![\w-])
    |(?P<phone>(?:\+\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|(?:\+\d{1,3}[ .-]?)?\d{3}[.-]\d{3}[.-]\d{4}|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5})(?![\w-])
    )""",
    re.X,
)
LATIN_SMALL, LATIN_CAPITAL = "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", LATIN_SMALL, LATIN_CAPITAL]
ALPHABET_OF = {c: a for a in ALPHABETS for c in a}


class Permutation:
    """Keyed permutations of range(n), one for each tweak and n."""

    def __init__(self, key: bytes):
        self.key = key[:64]

    def _round(self, tweak: bytes, i: int, half: int, bits: int) -> int:
        size = (bits + 7) // 8
        data = tweak + bytes([i]) + half.to_bytes((half.bit_length() + 7) // 8 or 1, "big")
        out = b""
        while len(out) < size:
            out += hashlib.blake2b(data + len(out).to_bytes(4, "big"), key=self.key).digest()
        return int.from_bytes(out[:size], "big") & ((1 << bits) - 1)

    def _feistel(self, x: int, bits: int, tweak: bytes, back: bool) -> int:
        half = bits // 2
        mask = (1 << half) - 1
        a, b = x >> half, x & mask
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            a, b = (b ^ self._round(tweak, i, a, half), a) if back else (b, a ^ self._round(tweak, i, b, half))
        return a << half | b

    def __call__(self, x: int, n: int, tweak: str, back: bool = False) -> int:
        if n < 2:
            return x
        bits = max(2, (n - 1).bit_length())
        bits += bits % 2
        tag = f"{tweak}/{n}/".encode()
        while True:
            x = self._feistel(x, bits, tag, back)
            if x < n:
                return x


def luhn_digit(body: str) -> str:
    total = 0
    for k, c in enumerate(reversed(body)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


class Pseudonymizer:
    def __init__(self, key: bytes):
        self.permute = Permutation(key)
        self.known: dict[tuple, tuple | None] = {}

    def digits(self, value: str, tweak: str, back: bool) -> str:
        return str(self.permute(int(value), 10 ** len(value), f"{tweak}{len(value)}", back)).zfill(len(value)) if value else value

    def letters(self, text: str, tweak: str, back: bool) -> str:
        """A text of the same classes of characters; others stay."""
        alphabets = [ALPHABET_OF.get(c) for c in text]
        x, n = 0, 1
        for c, a in zip(text, alphabets):
            if a:
                x, n = x * len(a) + a.index(c), n * len(a)
        shape = "".join(str(ALPHABETS.index(a)) if a else c for c, a in zip(text, alphabets))
        x, out = self.permute(x, n, tweak + shape, back), []
        for c, a in zip(reversed(text), reversed(alphabets)):
            if a:
                x, k = divmod(x, len(a))
                c = a[k]
            out.append(c)
        return "".join(reversed(out))

    @staticmethod
    def shaped(digits: str, like: str) -> str:
        it = iter(digits)
        return "".join(next(it) if c.isdigit() else c for c in like)

    def date(self, text: str, year_first: bool, back: bool) -> str | None:
        parts = re.split(r"([-/.])", text)
        y, m, d = (parts[0], parts[2], parts[4]) if year_first else (parts[4], parts[2], parts[0])
        us = not year_first and parts[1] == "/" and int(d) <= 12
        if us:
            m, d = d, m
        try:
            day = datetime.date(int(y), int(m), int(d)).toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        new = datetime.date.fromordinal(FIRST_DAY + self.permute(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date", back))
        # a form like 3/7/2021 has no leading zeros
        fill = 1 if min(len(m), len(d)) == 1 else 2
        m, d = str(new.month).zfill(fill), str(new.day).zfill(fill)
        sep = parts[1]
        if year_first:
            return sep.join((str(new.year), m, d))
        return sep.join((m, d, str(new.year)) if us else (d, m, str(new.year)))

    def replace(self, kind: str, text: str, back: bool = False) -> tuple[str, str] | None:
        """(kind, pseudonym); None if the text is not valid for its form."""
        if kind == "email":
            local, at, domain = text.rpartition("@")
            return "email", self.letters(local, "email", back) + at + domain
        if kind == "iban":
            plain = text.replace(" ", "")
            if not 15 <= len(plain) <= 34 or iban_rest(plain) != 1:
                return None
            body = self.letters(plain[4:], "iban" + plain[:2], back)
            check = f"{98 - iban_rest(plain[:2] + '00' + body):02d}"
            it = iter(plain[:2] + check + body)
            return "iban", "".join(c if c == " " else next(it) for c in text)
        if kind in ("ymd", "dmy"):
            new = self.date(text, kind == "ymd", back)
            return new and ("date", new)
        if kind == "ipv4":
            octets = [int(x) for x in text.split(".")]
            if max(octets) > 255:
                return None
            return "ipv4", ".".join(str(b) for b in self.permute(int.from_bytes(bytes(octets), "big"), 1 << 32, "ipv4", back).to_bytes(4, "big"))
        plain = "".join(c for c in text if c.isdigit())
        if kind == "ssn":
            if plain[:3] in ("000", "666") or plain[0] == "9" or plain[3:5] == "00" or plain[5:] == "0000":
                return None
            area = int(plain[:3])
            x = ((area - 1 - (area > 666)) * 99 + int(plain[3:5]) - 1) * 9999 + int(plain[5:]) - 1
            x = self.permute(x, 898 * 99 * 9999, "ssn", back)
            x, serial = divmod(x, 9999)
            area, group = divmod(x, 99)
            area += 1 + (area >= 665)
            return "ssn", f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"
        if kind == "number":
            if not 13 <= len(plain) <= 19:
                return None
            if luhn_digit(plain[:-1]) == plain[-1]:
                body = self.digits(plain[:-1], "card", back)
                return "card", self.shaped(body + luhn_digit(body), text)
            # numbers that fail the check are permuted among themselves, whatever the value of one that passes
            new = plain
            while True:
                new = self.digits(new, "account", back)
                if luhn_digit(new[:-1]) != new[-1]:
                    return "account", self.shaped(new, text)
        country = re.match(r"\+\d{1,3}(?=\D)", text)
        head = country[0] if country else ""
        rest = "".join(c for c in text[len(head) :] if c.isdigit())
        if not 7 <= len(plain) <= 15:
            return None
        return "phone", head + self.shaped(self.digits(rest, "phone", back), text[len(head) :])

    def spans(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, kind, pseudonym) of each find, from the left."""
        out, at = [], 0
        if not any(c in text for c in "0123456789@"):
            return out
        while m := FOUND.search(text, at):
            key = (m.lastgroup, m[0])
            if key not in self.known:
                if len(self.known) > REMEMBERED:
                    self.known.clear()
                self.known[key] = self.replace(*key)
            if found := self.known[key]:
                out.append((m.start(), m.end(), *found))
                at = m.end()
            else:
                at = m.start() + 1
        return out


_SESSION_KEYS: dict[str, bytes] = {}


def session_key(spark: SparkSession) -> bytes:
    """The secret named in ``lexbrook.pii.key``; else a random one for the application, the same in all its jobs."""
    if key := spark.conf.get("lexbrook.pii.key", ""):
        return key.encode()
    return _SESSION_KEYS.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


def apply_spans(text: str, spans: list[tuple[int, int, str, str]]) -> str:
    out, at = [], 0
    for start, end, _, new in spans:
        out += text[at:start], new
        at = end
    return "".join([*out, text[at:]])


def pseudonymize(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(id, text with pseudonyms, spans array<struct<start, end, kind, pseudonym>>, carry) for each row."""
    if not key:
        raise ValueError("a key is needed")

    def make():
        p = Pseudonymizer(key)
        span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("pseudonym", pa.string())])

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            texts, spans = [], []
            for t in b.column(1).to_pylist():
                found = p.spans(t) if t else []
                texts.append(apply_spans(t, found) if found else t)
                spans.append([dict(zip(("start", "end", "kind", "pseudonym"), s)) for s in found])
            return pa.record_batch([pa.array(texts, pa.string()), pa.array(spans, pa.list_(span))], names=["new", "spans"])

        return f

    schema = "new string, spans array<struct<start:int,end:int,kind:string,pseudonym:string>>"
    return map_arrow(rows_of(docs, id_col, text_col, carry), make, schema).withColumnsRenamed({"id": id_col, "new": text_col})
