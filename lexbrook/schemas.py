"""Schemas of the tables that the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

_STRINGS = "chamber docket_number_2 decision_date publication_date title legal_area regeste abstract_de abstract_fr abstract_it full_text decision_type outcome source_url pdf_url cited_decisions source source_id source_spider scraped_at content_hash json_data canonical_key".split()

#: One row a decision; the first five must not be null. Dates stay ISO text, since '' and 'None' carry meaning.
DECISION = T.StructType([T.StructField(c, T.StringType(), False) for c in ("decision_id", "court", "canton", "docket_number", "language")] + [T.StructField(c, T.StringType()) for c in _STRINGS])
EXPORT = T.StructType([*DECISION.fields, T.StructField("has_full_text", T.BooleanType()), T.StructField("text_length", T.IntegerType())])
GRAPH_INPUT = T.StructType([T.StructField(c, T.StringType()) for c in "decision_id docket_number court canton language decision_date title regeste full_text".split()])
SNAPSHOT = ("id long, source_key string, snapshot_year int, snapshot_date string, expected_count int, expected_ids array<string>, notes string")
DIGEST = ("law string, articles map<string, struct<summary: string, sources: array<string>>>")
CURRICULUM = (
    "area_id string, name_de string, name_fr string, modules array<struct<id: string, name_de: string, name_fr: string, cases: array<struct<bge_ref: string, title_de: string, title_fr: string, title_it: string, concepts_de: array<string>, concepts_fr: array<string>, concepts_it: array<string>, statutes: array<string>, difficulty: int, actual_language: string>>>>"
)
COMMENTARY = ("id string, law string, article string, language string, title string, authors array<string>, editors array<string>, text string, url string")
TRACE = ("type string, query string, query_language string, total_ms double, parse_ms double, is_docket boolean, changed boolean, result_langs array<string>, cross_lingual_positions array<int>")
EVENT = ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
