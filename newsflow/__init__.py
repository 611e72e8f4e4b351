"""Spark jobs for news and document data: ingest, dedupe, extract, enrich, validate, audit."""
