"""Scans and sinks: driver tables, landed files, bronze and mart tables."""
