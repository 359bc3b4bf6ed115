"""Readers. All take an explicit schema, so no file is read twice, and leave pruning and pushdown to Spark.

Malformed lines are dropped by reading permissively into a column of their own; they can be had back
with ``bad_lines``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import structure
from ..functions.text import html_to_text

BAD = "_bad"


def _permissive(spark: SparkSession, path, schema: T.StructType | str) -> DataFrame:
    wide = f"{schema}, {BAD} string" if isinstance(schema, str) else T.StructType([*(T.StructField(f.name, f.dataType) for f in schema.fields), T.StructField(BAD, T.StringType())])
    return spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD).json(path)


def jsonl(spark: SparkSession, path, schema: T.StructType = schemas.DECISION) -> DataFrame:
    """Records of JSON-lines files; blank and malformed lines are left out."""
    return _permissive(spark, path, schema).where(F.col(BAD).isNull()).drop(BAD)


def bad_lines(spark: SparkSession, path) -> DataFrame:
    """(file, line) of lines that are no JSON objects."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")).where(F.trim("line") != "")
    return lines.where(F.get_json_object("line", "$").isNull() | ~F.trim("line").startswith("{"))


def parquet(spark: SparkSession, path, columns: list[str] | None = None, courts: list[str] | None = None) -> DataFrame:
    """Shards, with only the columns and courts asked for read."""
    df = spark.read.parquet(path)
    df = df if courts is None else df.where(F.lower("court").isin([c.lower() for c in courts]))
    return df if columns is None else df.select(*columns)


def table(spark: SparkSession, url: str, name: str, columns: list[str] | None = None, courts: list[str] | None = None, **options) -> DataFrame:
    """A table of a database that a JDBC driver on the classpath reaches; columns and courts are pushed down."""
    df = spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()
    df = df if courts is None else df.where(F.lower("court").isin([c.lower() for c in courts]))
    return df if columns is None else df.select(*columns)


def graph_input(spark: SparkSession, *, parquet_path=None, jsonl_path=None, courts: list[str] | None = None) -> DataFrame:
    """The graph's nine columns, from a table where there is one, else from JSON lines."""
    names = schemas.GRAPH_INPUT.fieldNames()
    if parquet_path:
        return parquet(spark, parquet_path, names, courts)
    df = jsonl(spark, jsonl_path, schemas.GRAPH_INPUT)
    return df if courts is None else df.where(F.lower("court").isin([c.lower() for c in courts]))


def log_lines(spark: SparkSession, path, day: str | None = None) -> DataFrame:
    """Lines of logs, gzipped or not; a day is looked for near their start before anything is parsed."""
    df = spark.read.text(path)
    return df if day is None else df.where(F.substring("value", 1, 25).contains(day))


def laws(spark: SparkSession, path) -> DataFrame:
    """Articles of laws in XML files, with their file."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    return structure.table_of(files, structure.xml_articles, "article_num string, heading string, text string, footnote string", "file", "value")


def digests(spark: SparkSession, path) -> DataFrame:
    """(law, article, summary, source) of digests: one JSON object a file, articles by number."""
    df = spark.read.schema(schemas.DIGEST).option("multiLine", True).json(path)
    one = df.select("law", F.explode("articles").alias("article", "x"))
    return one.select("law", "article", "x.summary", F.explode_outer("x.sources").alias("source"))


def debates(spark: SparkSession, path) -> DataFrame:
    """(law, council, page_num, text) of files named law-ab-council.txt."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value").where(F.col("file").rlike("^[^-].*-ab-[^-]+\\.txt$"))
    pages = structure.table_of(files, structure.debate_pages, "page_num int, text string", "file", "value")
    return pages.select(F.upper(F.regexp_extract("file", r"^(.*)-ab-", 1)).alias("law"), F.lower(F.regexp_extract("file", r"-ab-([^.]+)\.txt$", 1)).alias("council"), "page_num", "text")


def by_precedence(frames: list[DataFrame], key: str) -> DataFrame:
    """Of several sources the rows of the first that has any for a key."""
    marked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.withColumn("_p", F.lit(i)) for i, f in enumerate(frames)])
    first = F.min("_p").over(Window.partitionBy(key))
    return marked.withColumn("_first", first).where("_p = _first").drop("_p", "_first")


def commentaries(spark: SparkSession, path) -> DataFrame:
    return spark.read.schema(schemas.COMMENTARY).option("multiLine", True).json(path)


def feed(spark: SparkSession, json_path, html_path) -> DataFrame:
    """Metadata objects with the text of the page of the same name."""
    wide = "Signatur string, Spider string, Sprache string, Datum string, Num array<string>"
    meta = spark.read.schema(wide).option("multiLine", True).json(json_path).withColumn("stem", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1))
    pages = spark.read.text(html_path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.html?$", 1).alias("stem"), html_to_text("value").alias("full_text"))
    return meta.join(pages, "stem", "left")


def ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids of a file in one of four forms: a JSON list of ids or of records, an object with a list, JSON lines, plain lines.

    The form is told from each line or, for whole JSON, from the file's first character.
    """
    whole = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    listed = whole.where(F.substring("v", 1, 1) == "[")
    a = listed.select(F.explode(F.from_json("v", "array<string>")).alias("x")).select(F.when(F.col("x").startswith("{"), F.get_json_object("x", "$.decision_id")).otherwise(F.col("x")).alias("decision_id"))
    b = whole.where(F.substring("v", 1, 1) == "{").select(F.explode(F.from_json(F.get_json_object("v", "$.decision_ids"), "array<string>")).alias("decision_id"))
    lines = whole.where(F.substring("v", 1, 1) != "[").where(F.get_json_object("v", "$.decision_ids").isNull()).select(F.explode(F.split("v", "\n")).alias("x"))
    c = lines.select(F.when(F.trim("x").startswith("{"), F.get_json_object("x", "$.decision_id")).otherwise(F.trim("x")).alias("decision_id"))
    return a.unionByName(b).unionByName(c).select(F.trim("decision_id").alias("decision_id")).where("decision_id <> ''").distinct()


def traces(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """Search traces and rerank traces."""
    df = jsonl(spark, path, schemas.TRACE)
    return df.where(F.coalesce("type", F.lit("")) != "rerank"), df.where("type = 'rerank'")


def curriculum(spark: SparkSession, path) -> DataFrame:
    """One row a case, with its area, module and place."""
    df = spark.read.schema(schemas.CURRICULUM).option("multiLine", True).json(path)
    mods = df.select("area_id", F.posexplode("modules").alias("m", "mod"))
    cases = mods.select("area_id", "m", F.col("mod.id").alias("module_id"), "mod.name_de", "mod.name_fr", F.posexplode("mod.cases").alias("c", "case"))
    return cases.select("area_id", "module_id", "name_de", "name_fr", (F.col("m") * 10_000 + F.col("c")).alias("position"), "case.*")
