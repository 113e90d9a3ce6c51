"""Spark jobs for large nested register records: ingest, repair, normalise, audit, project."""
