"""Composed plans: ingest, the cleaning plan, the query catalog and its SQL oracle."""
