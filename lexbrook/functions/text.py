"""Scalar functions over columns: identifiers, cleaning, language, dates, snippets.

All are built-in expressions, so they stay inside code generation and can be pushed around freely.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Entities that cleaning replaces, in this order.
ENTITIES = [("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'")]
#: Words that tell a language, for whole-word and for plain substring counting.
LANGUAGE_WORDS = {
    "de": ["der", "die", "das", "ein", "eine", "einer", "er", "sie", "ihn", "hat", "hatte", "hätte", "ist", "war", "sind"],
    "fr": ["le", "lui", "elle", "je", "on", "vous", "nous", "leur", "qui", "quand", "parce", "que", "faire", "sont", "vont"],
    "it": ["della", "del", "di", "casi", "una", "al", "questa", "più", "primo", "grado", "che", "diritto", "leggi", "corte"],
}
LANGUAGE_PARTS = {
    "fr": ["le ", "la ", "les ", "des ", "du ", "un ", "une ", "est ", "sont ", "dans ", "pour ", "que ", "qui "],
    "it": ["il ", "la ", "le ", "dei ", "del ", "un ", "una ", "che ", "per ", "con ", "sono ", "nella "],
    "de": ["der ", "die ", "das ", "den ", "dem ", "des ", "ein ", "eine ", "ist ", "sind ", "und ", "für "],
}
#: Month names.
MONTHS = {
    "de": ["januar", "februar", "märz", "april", "mai", "juni", "juli", "august", "september", "oktober", "november", "dezember"],
    "fr": ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"],
    "it": ["gennaio", "febbraio", "marzo", "aprile", "maggio", "giugno", "luglio", "agosto", "settembre", "ottobre", "novembre", "dicembre"],
}
MONTHS_EN = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
#: Court prefixes of two letters.
TWO_LETTER_PREFIXES = ["BB", "BG", "BH", "BK", "BN", "BP", "CA", "CB", "CR", "RR", "SK", "SN", "SP", "TP"]
#: User agents, the first that matches counts.
CLIENTS = [
    ("claude.ai", r"Claude-User|anthropic"), ("claude-code", r"claude-code"), ("chatgpt", r"undici|openai-mcp|ChatGPT"), ("cursor", r"Cursor/"), ("gemini", r"Gemini|Google-Extended"),
    ("googlebot", r"Googlebot|GoogleOther"), ("bingbot", r"bingbot|msnbot"), ("python-bot", r"python-httpx|python-requests|aiohttp|urllib"), ("node-bot", r"^node$|node-fetch|axios"),
    ("browser", r"Mozilla.*(?:Chrome|Firefox|Safari)"),
]


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c) -> Column:
    return F.coalesce(col(c), F.lit(""))


def let(value: Column, body) -> Column:
    """body(value) with value computed once, however often body names it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


# identifiers ---------------------------------------------------------------------------------


def normalize_docket(docket) -> Column:
    return F.regexp_replace(F.trim(col(docket)), r"[/\\]", "_")


def decision_id(court, docket) -> Column:
    return F.concat(col(court), F.lit("_"), normalize_docket(docket))


def alphanumeric(docket) -> Column:
    return F.regexp_replace(F.upper(text(docket)), "[^A-Z0-9]", "")


def compact_date(date) -> Column:
    return F.substring(F.replace(text(date), F.lit("-"), F.lit("")), 1, 8)


def canonical_key(court, docket, date) -> Column:
    """court|DOCKET|yyyymmdd, the docket without punctuation; reports lose their series' name."""
    plain = alphanumeric(docket)
    report = F.regexp_replace(plain, "^(?:CH)?(?:BGE|ATF|DTF)", "")
    return F.concat_ws("|", text(court), F.when(col(court) == "bge", report).otherwise(plain), compact_date(date))


def docket_norm(docket) -> Column:
    """Upper case with single underscores; volume_division_page gets spaces instead."""
    plain = F.regexp_replace(F.regexp_replace(F.translate(F.upper(F.trim(text(docket))), "-./", "___"), "_+", "_"), "^_+|_+$", "")
    return F.when(plain.rlike(r"^\d{1,3}_[IVX]{1,4}_\d{1,4}$"), F.translate(plain, "_", " ")).otherwise(plain)


def infer_court(norm) -> Column:
    c = col(norm)
    return (
        F.when(c.rlike(r"^[1-9][A-Z]_\d"), "bger")
        .when(c.rlike(r"^[A-F]_\d{1,6}_\d{4}$"), "bvger")
        .when(c.rlike(r"^[A-Z]{2}_") & F.substring(c, 1, 2).isin(TWO_LETTER_PREFIXES), "bstger")
    )


def id_part(c) -> Column:
    return F.regexp_replace(F.regexp_replace(text(c), "[^a-zA-Z0-9_.-]", "_"), "^_+|_+$", "")


def feed_id(court, docket, signature, date) -> Column:
    """court_docket_signature; without a signature the date if it is one, else neither."""
    d = F.when(id_part(docket) == "", "unknown").otherwise(id_part(docket))
    tail = F.when(id_part(signature) != "", F.concat(F.lit("_"), id_part(signature))).when(text(date).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(F.lit("_"), F.replace(text(date), F.lit("-"), F.lit("")))).otherwise("")
    return F.concat(col(court), F.lit("_"), d, tail)


def stable_id(*cols) -> Column:
    """A positive 31-bit id that is the same in every run."""
    return F.xxhash64(*(col(c) for c in cols)).bitwiseAND(0x7FFFFFFF)


# cleaning ------------------------------------------------------------------------------------


def fix_mojibake(c) -> Column:
    """UTF-8 that was read as Latin-1, put right where the whole text allows it."""
    back = F.try_validate_utf8(F.encode(col(c), "ISO-8859-1").cast("string"))
    return F.when(col(c).contains("Ã") & col(c).rlike(r"^[\x{00}-\x{FF}]*$"), F.coalesce(back, col(c))).otherwise(col(c))


def strip(c) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def clean_text(c) -> Column:
    t = F.regexp_replace(col(c), "<[^>]+>", " ")
    for entity, char in ENTITIES:
        t = F.replace(t, F.lit(entity), F.lit(char))
    return strip(F.regexp_replace(fix_mojibake(t), "[ \\t]+", " "))


def html_to_text(c) -> Column:
    """Visible lines of a page, by patterns alone."""
    t = F.regexp_replace(col(c), r"(?s)<script[^>]*>.*?</script>", "")
    t = F.regexp_replace(F.regexp_replace(t, r"(?s)<style[^>]*>.*?</style>", ""), "<[^>]+>", "\n")
    for entity, char in ENTITIES[:4]:
        t = F.replace(t, F.lit(entity), F.lit(char))
    lines = F.transform(F.split(F.regexp_replace(t, r"&#\d+;", ""), "\n"), strip)
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def truncate(c, n: int = 220) -> Column:
    t = F.trim(F.regexp_replace(text(c), r"(?U)\s+", " "))
    return F.when(F.length(t) <= n, t).otherwise(F.concat(F.rtrim(F.substring(t, 1, n - 1)), F.lit("…")))


def content_hash(c) -> Column:
    return F.md5(text(c))


def select_text(regeste, full_text) -> Column:
    """What a document is embedded by: its headnote, else the start of its text."""
    return F.when(F.length(text(regeste)) >= 20, col(regeste)).when(text(full_text) != "", F.substring(col(full_text), 1, 500))


def length_class(n) -> Column:
    c = col(n)
    return F.when(c == 0, "empty").when(c < 500, "1-499").when(c < 1000, "500-999").when(c < 3000, "1000-2999").otherwise("3000+")


def snippet(full_text, query: str) -> Column:
    """100 characters before and 200 after the start of the first query word; null without a find."""
    words = query.lower().split()
    if not words:
        return F.lit(None).cast("string")
    at = F.locate(words[0], F.lower(col(full_text)))
    start = F.greatest(at - 100, F.lit(1))
    end = F.least(F.length(col(full_text)) + 1, at + 200)
    body = F.concat(F.when(start > 1, "...").otherwise(""), F.substring(col(full_text), start, end - start), F.when(end <= F.length(col(full_text)), "...").otherwise(""))
    return F.when(at > 0, body)


def folded(c) -> Column:
    """Lower case without diacritics."""
    return F.translate(F.lower(col(c)), ACCENTED, PLAIN)


def _accents() -> tuple[str, str]:
    pairs = []
    for i in range(0xC0, 0x250):
        base = unicodedata.normalize("NFD", chr(i).lower())
        if len(base) > 1 and len(base[0]) == 1 and chr(i).lower() == chr(i):
            pairs.append((chr(i), base[0]))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accents()


def tokens(c) -> Column:
    return F.filter(F.split(folded(text(c)), r"[^\p{L}\p{N}]+"), lambda x: x != "")


# language ------------------------------------------------------------------------------------


def detect_language(c) -> Column:
    """The language with the most telling words in the first 5000 characters; ties go to the first."""
    head = F.substring(text(c), 1, 5000)
    n = {k: F.regexp_count(head, F.lit(rf"(?iuU)\b(?:{'|'.join(ws)})\b")) for k, ws in LANGUAGE_WORDS.items()}
    return F.when((n["de"] >= n["fr"]) & (n["de"] >= n["it"]), "de").when(n["fr"] >= n["it"], "fr").otherwise("it")


def detect_language_by_parts(c) -> Column:
    """By counts of substrings in the first 2000 characters; German unless another has strictly more."""
    head = F.lower(F.substring(text(c), 1, 2000))
    n = {k: sum(((F.length(head) - F.length(F.replace(head, F.lit(w), F.lit("")))) / len(w)).cast("int") for w in ws) for k, ws in LANGUAGE_PARTS.items()}
    return F.when((n["fr"] > n["de"]) & (n["fr"] > n["it"]), "fr").when((n["it"] > n["de"]) & (n["it"] > n["fr"]), "it").otherwise("de")


# dates ---------------------------------------------------------------------------------------


def iso(y, m, d) -> Column:
    """yyyy-mm-dd from parts that are strings; '' parts give null."""
    return F.when((y != "") & (m != "") & (d != ""), F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(m, 2, "0"), F.lpad(d, 2, "0")))


def month_number(name, names: list[str]) -> Column:
    """The number of a month's name as text; null if it is none."""
    out = F.lit(None).cast("string")
    for i, x in enumerate(names):
        out = F.when(F.lower(name) == x, F.lit(str(i + 1))).otherwise(out)
    return out


def parse_date(c) -> Column:
    """A date in one of the written forms: d.m.y, y-m-d, day month year in three languages, or a year alone."""
    t = F.trim(text(c))

    def parts(pattern, *groups):
        return [F.regexp_extract(t, pattern, g) for g in groups]

    d, m, y = parts(r"(\d{1,2})\.(\d{1,2})\.(\d{4})", 1, 2, 3)
    found = [iso(y, m, d).try_cast("date")]
    y, m, d = parts(r"(\d{4})-(\d{2})-(\d{2})", 1, 2, 3)
    found.append(iso(y, m, d).try_cast("date"))
    for lang, names in MONTHS.items():
        pattern = rf"(?iu)(\d{{1,2}})\.?\s*{'(?:er)?' if lang == 'fr' else ''}\s*({'|'.join(names)})\s+(\d{{4}})"
        d, name, y = parts(pattern, 1, 2, 3)
        found.append(iso(y, month_number(name, names), d).try_cast("date"))
    year = F.when(t.rlike(r"^\d{4}$"), t.try_cast("int"))
    found.append(F.when(year.between(1800, 2100), F.concat(t, F.lit("-01-01")).try_cast("date")))
    return F.coalesce(*found)


def date_from_docket(c) -> Column:
    """January 1st of the last four-digit number that can be a year."""
    years = F.filter(F.regexp_extract_all(text(c), F.lit(r"(?<![\p{L}\p{N}_])(\d{4})(?![\p{L}\p{N}_])"), 1), lambda x: x.cast("int").between(1801, 2099))
    return F.when(F.size(years) > 0, F.concat(F.try_element_at(years, F.lit(-1)), F.lit("-01-01")))


def date_from_text(c) -> Column:
    """The first d.m.y, else the first y-m-d, of the first 500 characters, if its parts are in range."""
    t = F.substring(text(c), 1, 500)
    out = []
    for pattern, (y, m, d) in ((r"\b(\d{1,2})\.\s*(\d{1,2})\.\s*(\d{4})\b", (3, 2, 1)), (r"\b(\d{4})-(\d{2})-(\d{2})\b", (1, 2, 3))):
        year, month, day = (F.regexp_extract(t, pattern, k) for k in (y, m, d))
        fits = (year != "") & year.try_cast("int").between(1801, 2099) & month.try_cast("int").between(1, 12) & day.try_cast("int").between(1, 31)
        out.append(F.when(fits, iso(year, month, day)))
    return F.coalesce(*out)


def is_missing_date(c) -> Column:
    return col(c).isNull() | col(c).isin("", "None")


def long_date(c, lang: str) -> Column:
    """A date written out, as citations do."""
    months = {**MONTHS, "en": MONTHS_EN}[lang]
    months = [m.capitalize() for m in months] if lang == "de" else months
    dot = "." if lang == "de" else ""
    prefix = {"de": "vom", "fr": "du", "it": "del", "en": "of"}[lang]
    d = col(c).try_cast("date")
    name = F.element_at(F.array(*map(F.lit, months)), F.month(d))
    return F.when(d.isNotNull(), F.concat(F.lit(prefix + " "), F.dayofmonth(d).cast("string"), F.lit(dot + " "), name, F.lit(" "), F.year(d).cast("string"))).otherwise("")


# logs ----------------------------------------------------------------------------------------


def status_bucket(c) -> Column:
    code = F.when(text(c).rlike(r"^\d+$"), text(c).try_cast("int"))
    return (
        F.when(code.between(200, 299), "2xx").when(code.between(300, 399), "3xx").when(code == 404, "404").when(code == 429, "429")
        .when(code.between(400, 499), "4xx").when(code.between(500, 599), "5xx").otherwise("other")
    )


def classify_client(agent, clients=CLIENTS) -> Column:
    out = F.lit("unknown")
    for name, pattern in reversed(clients):
        out = F.when(text(agent).rlike("(?i)" + pattern), name).otherwise(out)
    return out


def eli_parts(c) -> Column:
    """(kind, year, number) of a legislation identifier .../eli/kind/year/number."""
    t = text(c)
    return F.when(
        t.rlike(r"/eli/[a-z]+/\d{4}/[^/?#]+"),
        F.struct(*(F.regexp_extract(t, r"/eli/([a-z]+)/(\d{4})/([^/?#]+)", k).alias(n) for k, n in ((1, "kind"), (2, "year"), (3, "number")))),
    )


def query_terms(c) -> Column:
    """The first sentence of a headnote without its heading and article references, 100 characters."""
    t = F.regexp_replace(text(c), r"^(Regeste|Regesto|Résumé)\s*\n?\s*", "")
    t = F.get(F.split(t, r"[.;]\s"), F.lit(0))
    t = F.regexp_replace(t, r"Art\.?\s*\d+\w?\s*(Abs\.?\s*\d+\s*)?(lit\.?\s*\w\s*)?[A-Z]{2,}\d*/?[A-Z]*\s*[;,]?\s*", "")
    return F.trim(F.substring(F.trim(F.regexp_replace(t, r"(?U)\s+", " ")), 1, 100))


def report_reference(c) -> Column:
    """(volume, division, page) of a reference such as BGE 133 III 121 or 133 III 121."""
    t = F.trim(text(c))
    p = r"(?i)^(?:BGE|ATF|DTF)?\s*(\d{1,3})\s+([IVX]{1,4})\s+(\d{1,4})$"
    return F.when(t.rlike(p), F.struct(F.regexp_extract(t, p, 1).alias("volume"), F.upper(F.regexp_extract(t, p, 2)).alias("division"), F.regexp_extract(t, p, 3).alias("page")))


def as_json_list(c) -> Column:
    """A list column as JSON text; text stays."""
    return F.to_json(F.coalesce(col(c), F.array().cast("array<string>")))


def bullets(c) -> Column:
    return F.array_join(F.transform(col(c), lambda x: F.concat(F.lit("- "), x)), "\n")


def laplace_noise(scale: float, seed: int, *key) -> Column:
    """Laplace noise that the key and the seed determine, so that it does not depend on partitioning."""
    u = (F.pmod(F.xxhash64(F.lit(seed), *(col(k) for k in key)), F.lit(1 << 52)) + 0.5) / float(1 << 52) - 0.5
    return -scale * F.signum(u) * F.log(1 - 2 * F.abs(u))


def noisy_count(n, seed: int, *key, epsilon: float = 1.0, k: int = 10) -> Column:
    """A count for publication: null below k, else with noise, rounded half to even, not negative."""
    return F.when(col(n) >= k, F.greatest(F.lit(0), F.bround(col(n) + laplace_noise(1 / epsilon, seed, *key), 0).cast("long")))
