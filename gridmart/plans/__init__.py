"""Composed plans: the fact build, ingest, publish, and the registered queries."""
