"""First-wins, last-wins and best-version de-duplication, upserts and set operations.

Every choice among rows of a key is one window or one aggregation over that key; ties are broken by
the id, so results do not depend on partitioning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import alphanumeric, canonical_key, clean_text, col, compact_date, text

#: Groups of court codes that may hold the same decision twice.
OVERLAPS = [
    "zh_gerichte zh_obergericht zh_kassationsgericht zh_handelsgericht zh_bezirksgericht_zuerich zh_bezirksgericht_winterthur zh_bezirksgericht_horgen zh_bezirksgericht_dietikon zh_bezirksgericht_buelach zh_bezirksgericht_dielsdorf zh_bezirksgericht_uster zh_bezirksgericht_pfaeffikon zh_bezirksgericht_hinwil zh_bezirksgericht_meilen zh_bezirksgericht_affoltern zh_mietgericht zh_arbeitsgericht",
    "sg_gerichte sg_publikationen sg_versicherungsgericht sg_verwaltungsgericht sg_verwaltungsrekurskommission sg_kantonsgericht sg_handelsgericht",
    "ag_gerichte ag_obergericht ag_versicherungsgericht ag_handelsgericht ag_spezialverwaltungsgericht ag_strafgericht ag_zivilgericht ag_verwaltungsgericht ag_anwaltskommission ag_aufsichtskommission ag_regierungsrat ag_departement_bks ag_departement_bvu ag_departement_gs ag_departement_vi ag_justizgericht ag_justizleitung ag_weitere",
    "sh_gerichte sh_obergericht",
    "tg_gerichte tg_obergericht",
    "vd_findinfo vd_gerichte vd_omni",
    "bs_gerichte bs_appellationsgericht bs_sozialversicherungsgericht",
    "be_steuerrekurs be_verwaltungsgericht",
]
COURT_REMAP = {"bge_historical": "bge"}
REQUIRED = ["decision_id", "court", "canton", "docket_number", "language"]


def pick(df: DataFrame, key: list, order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; rows with a null key form one group each value."""
    w = Window.partitionBy(*(col(k) for k in key)).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def insert_or_ignore(new: DataFrame, existing: DataFrame | None, key: list[str], order: list[Column], required: list[str] = ()) -> DataFrame:
    """The rows of new that a table with that primary key would take: complete, first of their key, not there yet."""
    rows = reduce(lambda d, c: d.where(F.col(c).isNotNull()), required, new)
    rows = pick(rows, key, order)
    return rows if existing is None else rows.join(existing.select(*key), key, "left_anti")


def upsert_replace(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """old with the rows of new, which replace those of the same key."""
    return old.join(new.select(*key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def keep_last(lines: DataFrame, key: str, position: str) -> DataFrame:
    """The last row of each key; rows without a key all stay."""
    keyed = lines.where(F.coalesce(F.col(key), F.lit("")) != "")
    return pick(keyed, [key], [F.desc(position)]).unionByName(lines.where(F.coalesce(F.col(key), F.lit("")) == ""))


def content_length() -> Column:
    return F.length(text("full_text")) + F.length(text("regeste"))


def best_version(df: DataFrame) -> DataFrame:
    """Of rows with one canonical key the one with a headnote, then the longest text; rows without a usable key stay."""
    usable = F.coalesce((F.col("canonical_key") != "") & ~F.col("canonical_key").contains("||"), F.lit(False))
    order = [F.when(F.length(text("regeste")) > 0, 0).otherwise(1), F.desc(F.length(text("full_text"))), F.col("decision_id")]
    return pick(df.where(usable), ["canonical_key"], order).unionByName(df.where(~usable))


def best_version_by_docket(df: DataFrame) -> DataFrame:
    """The same where no row has a canonical key: by court, docket and date (null dates are equal)."""
    usable = F.length(F.trim(text("docket_number"))) > 0
    order = [F.when(F.length(text("regeste")) > 0, 0).otherwise(1), F.desc(F.length(text("full_text"))), F.col("decision_id")]
    return pick(df.where(usable), ["court", "docket_number", "decision_date"], order).unionByName(df.where(~usable))


def best_version_any_date(df: DataFrame) -> DataFrame:
    """Of rows with one court and docket, whatever their dates, the one with the most content."""
    parts = F.split(text("canonical_key"), "\\|")
    usable = (F.size(parts) == 3) & (F.coalesce(F.get(parts, F.lit(1)), F.lit("")) != "")
    keyed = df.withColumn("_key", F.when(usable, F.concat_ws("|", F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))))
    best = pick(keyed.where("_key IS NOT NULL"), ["_key"], [F.desc(content_length()), F.col("decision_id")])
    return best.unionByName(keyed.where("_key IS NULL")).drop("_key")


def overlap_group(court) -> Column:
    """The number of the group of courts; null outside of any."""
    out = F.lit(None).cast("int")
    for i, names in enumerate(OVERLAPS):
        out = F.when(col(court).isin(names.split()), i).otherwise(out)
    return out


def overlap_key(court, docket, date) -> Column:
    group = overlap_group(court)
    plain = alphanumeric(docket)
    plain = F.when(group == 4, F.regexp_replace(plain, r"NR(?=\d)", "")).otherwise(plain)
    return F.when(group.isNotNull() & (F.length(F.trim(text(docket))) > 0), F.concat_ws("|", group.cast("string"), plain, compact_date(date)))


def best_across_courts(df: DataFrame) -> DataFrame:
    """Of rows with one docket and date under overlapping courts the one with the most content."""
    keyed = df.withColumn("_key", overlap_key("court", "docket_number", "decision_date"))
    best = pick(keyed.where("_key IS NOT NULL"), ["_key"], [F.desc(content_length()), F.col("decision_id")])
    return best.unionByName(keyed.where("_key IS NULL")).drop("_key")


def without_stubs(df: DataFrame, least: int = 10) -> DataFrame:
    return df.where((F.length(text("full_text")) >= least) | (F.length(text("regeste")) >= least))


def cleansed(df: DataFrame) -> DataFrame:
    """Rows as they are stored: courts and ids remapped, texts cleaned, 'None' as null, key and blob computed."""
    court, did = F.col("court"), F.col("decision_id")
    for old, new in COURT_REMAP.items():
        did = F.when(did.startswith(old + "_"), F.concat(F.lit(new + "_"), F.substring(did, len(old) + 2, 1 << 20))).otherwise(did)
        court = F.when(court == old, new).otherwise(court)
    out = df.withColumns({"court": court, "decision_id": did} | {c: clean_text(c) for c in ("full_text", "regeste", "title") if c in df.columns})
    out = out.withColumn("canonical_key", canonical_key("court", "docket_number", "decision_date"))
    names = [c for c, t in out.dtypes if t == "string"]
    out = out.withColumn("json_data", F.to_json(F.struct(*(F.col(c) for c in df.columns))))
    return out.withColumns({c: F.nullif(F.col(c), F.lit("None")) for c in names})


def curated(df: DataFrame) -> DataFrame:
    """The cleaning passes in their order: clean, best version, any date, across courts, stubs."""
    return without_stubs(best_across_courts(best_version_any_date(best_version(cleansed(df)))))


def normalized_for_export(df: DataFrame) -> DataFrame:
    """Defaults for what must not be empty, no invented dates, computed columns."""

    def default(c, value):
        return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(value)).alias(c)

    defaults = {"decision_id": "unknown", "court": "unknown", "canton": "XX", "docket_number": "unknown", "language": "de", "full_text": "", "source_url": ""}
    out = df.withColumns({c: default(c, v) for c, v in defaults.items() if c in df.columns})
    dates = {c: F.nullif(F.col(c), F.lit("None")) for c in ("decision_date", "publication_date", "scraped_at") if c in df.columns}
    if "decision_date" in dates:
        dates["decision_date"] = F.nullif(dates["decision_date"], F.lit("1970-01-01"))
    out = out.withColumns(dates)
    return out.withColumns({"has_full_text": F.trim(text("full_text")) != "", "text_length": F.length(text("full_text"))})


def export_rows(df: DataFrame, position: list[Column], required: list[str] = tuple(REQUIRED)) -> DataFrame:
    """First-seen rows that are complete. The first copy of an id counts even if it is not complete itself."""
    first = pick(df, ["decision_id"], position)
    return reduce(lambda d, c: d.where(text(c) != ""), required, first)


def not_yet_known(new: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of new that known does not have by id, by source id, by court, docket and date, or, undated, by court and docket."""

    def keys(d: DataFrame) -> Column:
        dated = text("decision_date").rlike(r"^\d{4}-\d{2}-\d{2}$")
        docket = F.when((text("docket_number") != "") & (text("court") != ""), F.concat_ws("::", "court", "docket_number"))
        return F.array_compact(
            F.array(
                F.nullif(F.concat(F.lit("id::"), text("decision_id")), F.lit("id::")),
                F.when((text("source_id") != "") & (text("court") != ""), F.concat_ws("::", F.lit("source"), "court", "source_id")),
                F.when(dated, F.concat_ws("::", F.lit("docket"), docket, "decision_date")).otherwise(F.concat(F.lit("docket::"), docket)),
            )
        )

    seen = known.select(F.explode(keys(known)).alias("k")).distinct()
    hit = new.select("decision_id", F.explode(keys(new)).alias("k")).join(seen, "k", "left_semi").select("decision_id").distinct()
    return new.join(hit, "decision_id", "left_anti")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_shards(shards: list[DataFrame], key: list[str]) -> DataFrame:
    """All shards' rows; of one key the first shard's."""
    marked = union_all([s.withColumn("_shard", F.lit(i)) for i, s in enumerate(shards)])
    return pick(marked, key, [F.col("_shard")]).drop("_shard")
