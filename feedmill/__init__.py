"""Metadata-driven ingestion, mapping and data quality as Spark jobs."""
