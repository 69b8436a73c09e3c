"""Retail-banking analytics on Spark: ingest, clean, enrich, segment, flag and roll up."""
