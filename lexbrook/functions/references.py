"""References within texts: statutes, case citations, amendments; as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, let, text

#: The pattern of a statute reference.
ORDINAL = r"(?:bis|ter|quater|quinquies|sexies)"
NUMBER = rf"\d+(?:\s*{ORDINAL}|[a-z](?![a-z]))?"
STATUTE = (
    r"(?iuU)\b(?:Art(?:ikel|icle|icolo)?\.?)\s*(" + NUMBER + r")\s*(?:(?:Abs\.?|Absatz|al\.?|alin(?:ea)?\.?|cpv\.?|co\.?|para\.?)\s*(" + NUMBER + r"))?\s*"
    r"(?:(?:ff|ss|segg)\.?\s+)?(?:(?:Ziff(?:er)?|lit|Bst|Buchst|S|Satz|ch|let|n)\.?\s*(?:\d+|[a-z])\s+)?([A-Z][A-Z0-9]{1,11}(?:/[A-Z0-9]{2,6})?)\b"
)
#: Words that look like law abbreviations but are none.
NOT_LAWS = (
    "AL ABS ABSATZ ALIN ALINEA CPV PARA BIS TER QUATER QUINQUIES SEXIES FF SS SEGG ZIFF ZIFFER LIT BST BUCHST SATZ"
    " AB AM AN AUS BEI BZW DA DAS DEM DEN DER DES DIE DIES DURCH EIN EINE EINEM EINEN EINER EINES ER ES GEGEN HA IM IN IST JE MIT NACH NEBEN NICHT NOCH NUR ODER OHNE SICH SIE SIND SOWIE UM UND UNTER VOM VON VOR WAR WIE WIRD ZU ZUM ZUR ZWISCHEN"
    " AU AUX AVEC CE CES CETTE COMME DANS DE DU EN EST ET IL LA LE LES MAIS OU PAR PEUT POUR QUE QUI SE SONT SUR UN UNE"
    " CHE CON CUI DAL DEI DEL DELL DELLA DELLE DELLO DI FRA GLI NEL NELL NELLA NON PER SUL TRA UNA UNO"
    " ART CUM DRITTER ERSTER LETT LET LETTRE LITT NAPR PHR PRIMA RZ SECONDA ZWEITER AD AGB BI CH NE NI NO OF QU RE SI"
).split()
#: Forms of case citations.
REPORT = r"(?iuU)\bBGE\s+(\d{1,3})\s+([IVX]{1,4})\s+(\d{1,4})\b"
DOCKETS = [r"(?U)\b[A-Z0-9]{1,4}[._-]\d{1,6}[/_]\d{4}\b", r"(?U)\b[A-Z]{1,6}\.\d{4}\.\d{1,6}\b", r"(?iU)(?<!\bBGE\s{0,5})\b\d{1,3}\s+(?-i:[IVX]{1,4})\s+\d{1,4}\b"]
CITED = [r"(?U)\b(?:BGE|ATF|DTF)\s+(\d{1,3})\s+(I{1,3}[AV]?|V)\s+(\d+)\b", r"(?U)\b(?:\d[A-Z]_\d+/\d{4}|\d[A-Z]\.\d+/\d{4})\b", r"(?U)\b[A-F]-\d+/\d{4}\b", r"(?U)\b[A-Z]{2}\.\d{4}\.\d+\b"]
DOCUMENT_CITED = [r"(?:BGE|ATF|DTF)\s+\d+\s+[IVX]+\s+\d+", r"\d[A-Z]_\d+/\d{4}"]
AMENDMENT = r"\b(AS|BBl|FF|RO|RU)\s+(\d{4})\s+(\d+)\b"
AMENDMENT_URLS = {
    "AS": "https://www.fedlex.admin.ch/eli/oc/{year}/{page}", "BBl": "https://www.fedlex.admin.ch/eli/fga/{year}/{page}", "FF": "https://www.fedlex.admin.ch/eli/fga/{year}/{page}",
    "RO": "https://www.fedlex.admin.ch/eli/oc/{year}/{page}", "RU": "https://www.fedlex.admin.ch/eli/oc/{year}/{page}",
}


def every(c, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text(c), F.lit(pattern), group)


def squeezed(c) -> Column:
    return F.lower(F.regexp_replace(c, r"(?U)\s+", ""))


def statute_references(c) -> Column:
    """array<struct<raw, law, article, paragraph, normalized>> in order, each reference once."""

    def parts(raw):
        article, paragraph = squeezed(F.regexp_extract(raw, STATUTE, 1)), squeezed(F.regexp_extract(raw, STATUTE, 2))
        written = F.regexp_extract(raw, STATUTE, 3)
        law = F.upper(written)
        normalized = F.concat(F.lit("ART."), article, F.when(paragraph != "", F.concat(F.lit(".ABS."), paragraph)).otherwise(""), F.lit("."), law)
        capitals = F.length(F.regexp_replace(written, r"\P{Lu}", ""))
        return F.struct(raw.alias("raw"), law.alias("law"), article.alias("article"), F.nullif(paragraph, F.lit("")).alias("paragraph"), normalized.alias("normalized"), capitals.alias("capitals"), F.length(written).alias("n"))

    found = F.transform(every(c, STATUTE), parts)
    laws = F.filter(found, lambda x: (x["capitals"] > 0) & ~((x["capitals"] == 1) & (x["n"] > 3)) & ~x["law"].isin(NOT_LAWS))
    return first_by(laws, "normalized", ["raw", "law", "article", "paragraph", "normalized"])


def first_by(items: Column, key: str, fields: list[str]) -> Column:
    """The first struct of each key, in order: sorted by key and place, then by place again."""

    def kept(s):
        marked = F.transform(s, lambda y, j: F.struct(y["i"].alias("i"), y["x"].alias("x"), F.coalesce(F.get(s, j - 1)["k"] != y["k"], F.lit(True)).alias("first")))
        return F.array_sort(F.filter(marked, lambda y: y["first"]))

    placed = F.transform(items, lambda x, i: F.struct(x[key].alias("k"), i.alias("i"), x.alias("x")))
    return F.transform(let(F.array_sort(placed), kept), lambda y: F.struct(*(y["x"][f].alias(f) for f in fields)))


def normalized_citation(raw) -> Column:
    """Volume, division and page keep single spaces; dockets get underscores."""
    compact = F.regexp_replace(F.upper(F.trim(raw)), r"(?U)\s+", " ")
    docket = F.regexp_replace(F.regexp_replace(F.translate(F.upper(F.trim(raw)), "-./", "___"), "_+", "_"), "^_+|_+$", "")
    return F.when(compact.rlike(r"^\d{1,3} [IVX]{1,4} \d{1,4}$"), compact).otherwise(docket)


def case_citations(c) -> Column:
    """array<struct<raw, kind, normalized>>: reports first, then dockets by form, each once."""
    reports = F.transform(every(c, REPORT), lambda r: F.struct(r.alias("raw"), F.lit("bge").alias("kind"), F.regexp_replace(F.upper(r), r"(?U)\s+", " ").alias("normalized")))
    dockets = [F.transform(every(c, p), lambda r: F.struct(r.alias("raw"), F.lit("docket").alias("kind"), normalized_citation(r).alias("normalized"))) for p in DOCKETS]
    return first_by(F.filter(F.concat(reports, *dockets), lambda x: x["normalized"] != ""), "normalized", ["raw", "kind", "normalized"])


def cited_decisions(c) -> Column:
    """Sorted distinct citations in the form that records carry."""
    reports = F.transform(every(c, CITED[0]), lambda r: F.concat(F.lit("BGE "), F.regexp_extract(r, CITED[0], 1), F.lit(" "), F.regexp_extract(r, CITED[0], 2), F.lit(" "), F.regexp_extract(r, CITED[0], 3)))
    return F.array_sort(F.array_distinct(F.concat(reports, *(every(c, p) for p in CITED[1:]))))


def document_citations(c) -> Column:
    """Distinct citations of a document in order of forms."""
    return F.array_distinct(F.concat(*(every(c, p) for p in DOCUMENT_CITED)))


def amendment_references(c) -> Column:
    """array<struct<kind, year, page, context, url>>; context: 80 characters on both sides.

    The text is cut once, before and behind each reference, so every other piece is one; of the others only the ends count.
    """
    mark = "\x01"
    cut = F.split(F.regexp_replace(F.replace(text(c), F.lit(mark), F.lit(" ")), AMENDMENT, f"{mark}$0{mark}"), mark)

    def named(raw):
        return F.struct(*(F.regexp_extract(raw, AMENDMENT, k).alias(name) for k, name in enumerate(("kind", "year", "page"), 1)))

    def one(x, i, heads, tails):
        kind, year, page = x["kind"], x["year"], x["page"]
        n = F.length(kind) + F.length(year) + F.length(page) + 2
        # a reference has nine characters or more, so ten of them, and what stands between, reach far enough
        before = F.array_join(F.slice(tails, F.greatest(2 * i - 18, F.lit(1)), F.least(2 * i + 2, F.lit(21))), "")
        around = F.concat(F.substring(before, F.lit(-80) - n, n + 80), F.substring(F.array_join(F.slice(heads, 2 * i + 3, 21), ""), 1, 80))
        url = F.lit(None).cast("string")
        for k, form in AMENDMENT_URLS.items():
            head = form.split("{year}")[0]
            url = F.when(kind == k, F.concat(F.lit(head), year, F.lit("/"), page)).otherwise(url)
        return F.struct(kind.alias("kind"), year.cast("int").alias("year"), page.cast("int").alias("page"), F.trim(F.replace(around, F.lit("\n"), F.lit(" "))).alias("context"), url.alias("url"))

    def every_one(pieces):
        found = F.transform(F.filter(pieces, lambda x, i: i % 2 == 1), named)
        heads = F.transform(pieces, lambda x, i: F.when(i % 2 == 1, x).otherwise(F.substring(x, 1, 80)))
        tails = F.transform(pieces, lambda x, i: F.when(i % 2 == 1, x).otherwise(F.substring(x, -80, 80)))
        ends = F.struct(found.alias("found"), heads.alias("heads"), tails.alias("tails"))
        return let(ends, lambda e: F.transform(e["found"], lambda x, i: one(x, i, e["heads"], e["tails"])))

    return let(cut, every_one)


def docket_candidates(c) -> Column:
    """Spellings of a docket that an id may hide, the likeliest first."""
    bare = F.regexp_replace(text(c), "^[a-z]+(?:_[a-z]+)*_", "")
    return F.array_distinct(F.array(bare, F.regexp_replace(bare, r"_(\d{4})$", "/$1"), F.regexp_replace(bare, r"^(\d[A-Z])_(\d+)_(\d{4})$", "$1_$2/$3"), F.translate(bare, "_", " "), F.translate(bare, "_", ".")))


def formatted_citation(court, docket, date, lang: str, paragraph=None) -> Column:
    """A citation as written in a language: reports by their series, others with court and date."""
    #: courts' short names, and the label of a paragraph.
    names = {
        "bger": {"de": "BGer", "fr": "TF", "it": "TF", "en": "BGer"}, "bge": {"de": "BGE", "fr": "ATF", "it": "DTF", "en": "BGE"}, "bvger": {"de": "BVGer", "fr": "TAF", "it": "TAF", "en": "BVGer"},
        "bstger": {"de": "BStGer", "fr": "TPF", "it": "TPF", "en": "BStGer"}, "bpatger": {"de": "BPatGer", "fr": "TFB", "it": "TFB", "en": "BPatGer"},
    }
    label = {"de": "E.", "fr": "consid.", "it": "consid.", "en": "para."}[lang]
    from .text import long_date

    name = F.lower(col(court))
    for k, x in names.items():
        name = F.when(F.lower(col(court)) == k, x[lang]).otherwise(name)
    bare = F.regexp_replace(text(docket), r"^(?:BGE|ATF|DTF)\s+", "")
    dated = F.when(text(date) != "", F.concat(F.lit(" "), long_date(date, lang))).otherwise("")
    body = F.when(F.lower(col(court)) == "bge", F.concat(F.lit(names["bge"][lang] + " "), bare)).otherwise(F.concat(name, F.lit(" "), text(docket), dated))
    tail = F.when(text(paragraph) != "", F.concat(F.lit(f", {label} "), col(paragraph))).otherwise("") if paragraph is not None else F.lit("")
    return F.concat(F.lit("("), body, tail, F.lit(")"))
