"""A Spark-first engine for legal-text corpora: ingest, clean, de-duplicate, index, link, measure."""
