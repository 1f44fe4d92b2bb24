"""Periodic operational reporting on Spark: windowed ingest, keyed merge, reports, archives."""
