"""The date of a decision from its text: candidates by place, a veto for dates of laws, and which of them counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import MONTHS, MONTHS_EN, col, let, text

#: Names of months beside the usual ones.
MORE_MONTHS = {"jänner": 1, "maerz": 3, "fevrier": 2, "aout": 8, "decembre": 12}
MONTH_OF = {name.lower(): i + 1 for names in (*MONTHS.values(), MONTHS_EN) for i, name in enumerate(names)} | MORE_MONTHS
NAMES = "|".join(sorted(MONTH_OF, key=len, reverse=True))
#: How a heading and a sign-off write the date, in order of preference, each with the method's name.
HEADINGS = [
    ("echr", rf"Arr[êe]t\s+no\.\s*\d+/\d+,\s*(\d{{1,2}})(?:er)?\s+({NAMES})\s+(\d{{4}})"),
    ("header_fr", rf"(?:Arr[êe]t|Jugement|D[ée]cision|Ordonnance|Sentence)\s+du\s+(\d{{1,2}})(?:er)?\s+({NAMES})\s+(\d{{4}})"),
    ("header_de", rf"(?:Urteil|Entscheid|Beschluss|Verfügung|Zwischenentscheid|Teilurteil)\s+vom\s+(\d{{1,2}})\.\s*({NAMES})\s+(\d{{4}})"),
    ("header_it", rf"(?:Sentenza|Decisione|Giudizio|Decreto)\s+del\s+(\d{{1,2}})\s+({NAMES})\s+(\d{{4}})"),
]
PLACE = r"[A-ZÀ-Ü][a-zà-ü]++(?:-[A-ZÀ-Ü][a-zà-ü]++)?"
AFTER_PLACE = [rf",\s*le\s+(\d{{1,2}})(?:er)?\s+({NAMES})\s+(\d{{4}})", rf",\s*(?:den\s+)?(\d{{1,2}})\.\s*({NAMES})\s+(\d{{4}})", rf",\s*(?:il\s+)?(\d{{1,2}})\s+({NAMES})\s+(\d{{4}})"]
BARE = rf"(?<!\d)(\d{{1,2}})\.?\s+({NAMES})\s+(\d{{4}})(?!\d)"
NUMERIC = r"(?<!\d)(\d{1,2})\.(\d{1,2})\.(\d{4})(?!\d)"
#: What stands beside the date of a law.
LAW_SIGNS = ["gesetz", "bgb", "bgg", "bv ", "or ", "zgb", "stgb", "stpo", "zpo", "loi ", "legge", "verordnung", "reglement", "sr ", "rs ", "(sr", "(rs", "du 17 juin 2005", "du 20 mars 1981", "vom 17. juni 2005"]
NEAR_SPELLED = rf"(?:(?:vom|du|del|le|dès\s+le)\s+)?(\d{{1,2}})\.?\s+({NAMES})\s+(\d{{4}})"
NEAR_DOTTED, NEAR_ISO = r"\b(\d{1,2})\.(0[1-9]|1[0-2])\.(\d{4})\b", r"\b((?:19|20)\d{2})-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])\b"
ZONE, NARROW, AROUND, LEAST_TEXT = 1500, 500, 30, 50
FLAGS = "(?iu)"
LEVELS = ["none", "low", "medium", "high"]


def month_of(name) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in MONTH_OF.items() for x in pair)), F.lower(name))


def _parts(raw, pattern: str, year_first: bool = False) -> tuple[Column, Column, Column]:
    """Year, month and day as numbers; null where there is no match."""
    a, b, c = (F.nullif(F.regexp_extract(raw, FLAGS + pattern, k), F.lit("")) for k in (1, 2, 3))
    y, m, d = (a, b, c) if year_first else (c, b, a)
    return y.try_cast("int"), (month_of(m) if NAMES in pattern else m.try_cast("int")), d.try_cast("int")


def _date(raw, pattern: str) -> Column:
    """The date that a find of the pattern writes."""
    parts = F.struct(*(x.alias(k) for k, x in zip("ymd", _parts(raw, pattern))))
    whole = lambda x: F.concat_ws("-", F.lpad(x["y"].cast("string"), 4, "0"), F.lpad(x["m"].cast("string"), 2, "0"), F.lpad(x["d"].cast("string"), 2, "0"))
    return let(parts, lambda x: F.when(x["y"].between(1800, 2100), whole(x).try_cast("date")))


def finds(zone, pattern: str) -> Column:
    """array<struct<raw, date, near>> of all matches, each with what stands AROUND it."""
    begin, end = "\x01", "\x02"
    cut = F.split(F.regexp_replace(F.translate(zone, begin + end, "  "), FLAGS + pattern, f"{begin}$0{end}"), begin)

    def one(pieces, k):
        before = F.translate(F.array_join(F.slice(pieces, F.lit(1), k), ""), end, "")
        after = F.translate(F.array_join(F.slice(pieces, k + 1, F.size(pieces)), ""), end, "")

        def placed(raw):
            near = F.concat(F.substring(before, -AROUND, AROUND), raw, after.substr(F.length(raw) + 1, F.lit(AROUND)))
            return F.struct(raw.alias("raw"), _date(raw, pattern).alias("date"), near.alias("near"))

        return let(F.substring_index(F.get(pieces, k), end, 1), placed)

    def every(pieces):
        return F.transform(F.sequence(F.lit(1), F.size(pieces) - 1), lambda k: one(pieces, k))

    return F.when(zone.rlike(FLAGS + pattern), let(cut, every))


def beside_law(near) -> Column:
    """Whether a date belongs to a law, by what stands beside it."""

    def signed(low):
        out = F.lit(False)
        for sign in LAW_SIGNS:
            out |= low.contains(sign)
        return out

    return let(F.lower(near), signed)


def _first(found, since: int) -> Column:
    """The first find of a date since a year that is not a law's."""
    return F.get(F.filter(found, lambda x: x["date"].isNotNull() & (F.year(x["date"]) >= since) & ~beside_law(x["near"])), F.lit(0))


def heading_date(t) -> Column:
    """struct<date, method>: the date of the heading; one without a heading's words only near the beginning."""

    def named(date, name: str):
        return let(date, lambda d: F.when(d.isNotNull(), F.struct(d.alias("date"), F.lit(name).alias("method"))))

    def typed(zone):
        return F.coalesce(*(let(F.regexp_extract(zone, FLAGS + p, 0), lambda raw: F.when(raw != "", named(_date(raw, p), name))) for name, p in HEADINGS))  # noqa: B023

    return F.coalesce(let(t.substr(1, ZONE), typed), named(_first(let(t.substr(1, NARROW), lambda z: finds(z, BARE)), 1900)["date"], "bare_header"))


def sign_off_date(t) -> Column:
    """The date of the last sign-off near the end, by the first form whose last one is a date and not a law's."""

    def last(tail, after: str):
        # what follows a place begins with a comma, so it is soon told whether there is any
        return F.when(tail.rlike(FLAGS + after), let(F.try_element_at(finds(tail, PLACE + after), F.lit(-1)), lambda x: F.when(~beside_law(x["near"]), x["date"])))

    return let(t.substr(F.greatest(F.length(t) - ZONE + 1, F.lit(1)), F.lit(ZONE)), lambda tail: F.coalesce(*(last(tail, x) for x in AFTER_PLACE)))


def decision_date(c) -> Column:
    """struct<date, method, confidence>: the heading's and the sign-off's date weighed against each other.

    If they agree both count. A heading's date counts unless the sign-off is over a year away (then the heading names
    an earlier decision); a bare date never counts against a sign-off. Without either a numeric date of the heading may do.
    """

    def result(date, method, confidence):
        return F.struct(date.alias("date"), method.alias("method"), confidence.alias("confidence"))

    def weighed(head, end):
        typed = head["method"] != "bare_header"
        apart = F.abs(F.datediff(head["date"], end))
        medium, signed = F.lit("medium"), F.lit("signoff")
        both = F.when(apart == 0, result(head["date"], F.lit("both"), F.lit("high"))).when(typed & (apart <= 365), result(head["date"], head["method"], medium)).otherwise(result(end, signed, medium))
        alone = result(head["date"], head["method"], F.when(typed, "high").otherwise("medium"))
        return F.when(head["date"].isNotNull() & end.isNotNull(), both).when(head["date"].isNotNull(), alone).when(end.isNotNull(), result(end, signed, medium))

    none = result(F.lit(None).cast("date"), F.lit(""), F.lit("none"))

    def told(t):
        numeric = _first(let(t.substr(1, ZONE), lambda z: finds(z, NUMERIC)), 1900)["date"]
        number = let(numeric, lambda d: F.when(d.isNotNull(), result(d, F.lit("numeric"), F.lit("low"))))
        found = let(F.struct(heading_date(t).alias("head"), sign_off_date(t).alias("end")), lambda x: weighed(x["head"], x["end"]))
        return F.when(F.length(t) < LEAST_TEXT, none).otherwise(F.coalesce(found, number, none))

    return let(text(c), told)


def category(found, known) -> Column:
    """How a date that is found (struct<date, confidence>) compares with the one that is known."""
    known = F.when(col(known).cast("string").isin("0001-01-01", "0000-00-00", ""), None).otherwise(col(known)).try_cast("date")
    none = known.isNull()
    return (
        F.when(none & found["date"].isNotNull(), "NULL_METADATA_FIXABLE").when(none, "NULL_METADATA_DATE").when(found["date"].isNull(), "NO_DATE_EXTRACTED")
        .when(found["date"] == known, "MATCH").when(found["confidence"].isin("high", "medium"), "MISMATCH_FIXABLE").otherwise("MISMATCH_AMBIGUOUS")
    )


def nearest_date(c) -> Column:
    """yyyy-mm-dd: the first date of 1900 to 2030 in the first 2000 characters, written out, else with dots, else ISO; days up to 31 in any month."""
    t = text(c).substr(1, 2000)

    def first(pattern: str, year_first: bool = False):
        def written(raw):
            y, m, d = _parts(raw, pattern, year_first)
            return F.when(y.between(1900, 2030) & d.between(1, 31) & m.isNotNull(), F.concat_ws("-", y.cast("string"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0")))

        return F.get(F.filter(F.transform(F.regexp_extract_all(t, F.lit(FLAGS + pattern), 0), written), lambda x: x.isNotNull()), F.lit(0))

    return F.coalesce(first(NEAR_SPELLED), first(NEAR_DOTTED), first(NEAR_ISO, True))


def decision_year(date, docket, identifier) -> Column:
    """The year of a decision from its date, else the first year in its docket, else in its id."""

    def fits(c):
        y = c.try_cast("int")
        return F.when(y.between(1800, 2100), y)

    def within(c):
        return F.get(F.filter(F.transform(F.regexp_extract_all(text(c), F.lit(r"(?<!\d)((?:18|19|20|21)\d{2})(?!\d)"), 1), fits), lambda y: y.isNotNull()), F.lit(0))

    return F.coalesce(fits(F.regexp_extract(F.trim(col(date).cast("string")), r"^(\d{4})", 1)), within(docket), within(identifier))
