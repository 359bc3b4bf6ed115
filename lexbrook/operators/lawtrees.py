"""Laws that come as nested documents, as tables: a row a node, and from these articles and whole texts.

A node is {type, number, text, html_content, children}; number, text and html_content hold one string a language. Trees are
parsed once, as variants, and opened level by level: each step takes all nodes of a depth to their children, which
moves no row to another machine, so a law may have any number of nodes and be of any depth.
"""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let, strip
from .lineage import checkpointed

#: Types of nodes within an article whose own text and whose children's count; the text of other types counts, their children's does not.
OPEN = ("paragraph", "enumeration")
SILENT = ("footnote_reference", "footnote")
#: Named entities that laws use, and numbers of characters.
ENTITIES = ("nbsp", "lt", "gt", "quot", "apos", "auml", "ouml", "uuml", "Auml", "Ouml", "Uuml", "szlig", "sect", "ndash", "mdash", "laquo", "raquo", "eacute", "egrave", "agrave", "ccedil", "hellip", "rsquo", "bdquo", "ldquo", "amp")


def plain(c: Column) -> Column:
    """The lines of a snippet of markup, with entities decoded and white space made even; '' for null."""

    def opened(t):
        t = let(t, lambda x: F.when(x.contains("<br"), F.regexp_replace(x, r"<br\s*/?>", "\n")).otherwise(x))
        t = F.regexp_replace(t, r"</(?:p|div|li|tr)>", "\n")
        t = let(t, lambda x: F.when(x.contains("number"), F.regexp_replace(x, r"<span\s+class=['\"]number['\"]>([^<]*)</span>", "$1 ")).otherwise(x))
        return F.regexp_replace(t, "<[^>]+>", "")

    t = let(F.coalesce(c, F.lit("")), lambda x: F.when(x.contains("<"), opened(x)).otherwise(x))
    lines = F.transform(F.split(decoded(t), "\n"), lambda x: strip(F.regexp_replace(x, "[ \\t]{2,}|\\t", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def decoded(c: Column) -> Column:
    """Named entities of ENTITIES and decimal ones; &amp; last, so that nothing is decoded twice. Texts without & are as they are."""
    number = lambda x: F.regexp_extract(x, r"^&#(\d{1,6});", 1)

    def numbered(x):
        parts = F.split(x, r"(?=&#\d{1,6};)")
        return F.array_join(F.transform(parts, lambda p: F.when(number(p) != "", F.concat(code_point(number(p)), F.regexp_replace(p, r"^&#\d{1,6};", ""))).otherwise(p)), "")

    def every(x):
        t = F.when(x.contains("&#"), numbered(x)).otherwise(x)
        for name in ENTITIES:
            t = F.replace(t, F.lit(f"&{name};"), F.lit(html.unescape(f"&{name};")))
        return t

    return let(c, lambda x: F.when(x.contains("&"), every(x)).otherwise(x))


def code_point(number: Column) -> Column:
    """The character of a decimal number, as text; U+FFFD for one that is none."""
    n = number.cast("int")
    rest = n - 0x10000
    pair = F.concat(F.hex(F.lit(0xD800) + F.shiftright(rest, 10)), F.hex(F.lit(0xDC00) + rest.bitwiseAND(0x3FF)))
    units = F.when(n.between(0x10000, 0x10FFFF), pair).when((n < 1) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "FFFD").otherwise(F.lpad(F.hex(n), 4, "0"))
    return F.decode(F.unhex(units), "UTF-16BE")


def nodes(laws: DataFrame, id_col: str = "law_id", tree_col: str = "tree", language: str = "de") -> DataFrame:
    """(id, place, type, number, title, text, article, under) of each node that counts.

    place: its way from the top as positions; article: the place of the article that it lies in, itself included; under: the
    heading of the nearest title above. A text that is no tree gives nothing.
    """
    own = lambda c: F.coalesce(F.try_variant_get("node", f"$.{c}.{language}", "string"), F.lit(""))
    level = laws.select(F.col(id_col), F.try_parse_json(tree_col).alias("node"), F.array().cast("array<int>").alias("place"), F.lit(None).cast("array<int>").alias("article"), F.lit("").alias("under"))
    level = level.where(F.col(id_col).isNotNull() & F.col("node").isNotNull())
    out = None
    while True:
        kind = F.coalesce(F.try_variant_get("node", "$.type", "string"), F.lit(""))
        level = level.withColumn("type", kind).where(F.col("article").isNull() | ~F.col("type").isin(*SILENT))
        level = level.withColumn("inside", F.col("article").isNotNull()).withColumn("article", F.when(~F.col("inside") & (F.col("type") == "article"), F.col("place")).otherwise(F.col("article")))
        level = checkpointed(level)
        if level.isEmpty():
            break
        rows = level.select(id_col, "place", "type", decoded(own("number")).alias("number"), own("text").alias("title"), plain(own("html_content")).alias("text"), "article", "under")
        out = rows if out is None else out.unionByName(rows)
        heading = strip(F.concat_ws(" ", F.nullif(own("number"), F.lit("")), F.coalesce(F.nullif(own("text"), F.lit("")), plain(own("html_content")))))
        opened = level.where(~F.col("inside") | F.col("type").isin(*OPEN)).withColumn("under", F.when((F.col("type") == "title") & ~F.col("inside") & (heading != ""), heading).otherwise(F.col("under")))
        child = opened.select(id_col, "place", "article", "under", F.posexplode(F.try_variant_get("node", "$.children", "array<variant>")).alias("at", "node"))
        level = child.select(id_col, "node", F.concat("place", F.array("at")).alias("place"), "article", "under")
    if out is None:
        schema = f"`{id_col}` {laws.schema[id_col].dataType.simpleString()}, place array<int>, type string, number string, title string, text string, article array<int>, under string"
        return laws.sparkSession.createDataFrame([], schema)
    return out


def articles(found: DataFrame, id_col: str = "law_id") -> DataFrame:
    """(id, place, article_num, heading, under, text) from nodes: texts of an article's parts, in order; articles without heading and text are left out."""
    inside = found.where("article IS NOT NULL")
    own = inside.where(F.col("place") == F.col("article")).select(id_col, "place", article_number("number").alias("article_num"), F.col("title").alias("heading"), "under")
    # empty texts are left out behind the grouping: a condition on them would be asked where they are made, and make them twice
    parts = inside.where(F.col("place") != F.col("article"))
    texts = parts.groupBy(id_col, F.col("article").alias("place")).agg(F.array_sort(F.collect_list(F.struct("place", "text"))).alias("x"))
    texts = texts.select(id_col, "place", F.array_join(F.filter("x.text", lambda t: t != ""), "\n").alias("text"))
    return own.join(texts, [id_col, "place"], "left").withColumn("text", F.coalesce("text", F.lit(""))).where("text <> '' OR heading <> ''")


def article_number(c) -> Column:
    return F.trim(F.regexp_replace(F.col(c), r"(?U)^[§Art.\s]+", ""))


def whole_texts(found: DataFrame, id_col: str = "law_id") -> DataFrame:
    """(id, full_text) from nodes: headings, headers of articles and their texts, in order."""
    head = strip(F.concat_ws(" ", F.nullif(F.col("number"), F.lit("")), F.coalesce(F.nullif("title", F.lit("")), "text")))
    titles = found.where("article IS NULL AND type = 'title'").select(id_col, "place", F.array(head).alias("lines"))
    a = articles(found, id_col)
    header = F.concat_ws(" ", F.when(F.col("article_num") != "", F.concat(F.lit("Art. "), "article_num")), F.nullif("heading", F.lit("")))
    lines = titles.unionByName(a.select(id_col, "place", F.array(header, F.col("text")).alias("lines")))
    ordered = lines.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("place", "lines"))).alias("x"))
    return ordered.select(id_col, F.array_join(F.filter(F.flatten("x.lines"), lambda t: t != ""), "\n\n").alias("full_text"))
