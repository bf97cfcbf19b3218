"""Whole jobs: ingestion, layered models, batch report and dashboard figures."""
