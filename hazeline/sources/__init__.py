"""Scans: driver tables, the readings adapter and its landing, CSV and JSON."""
