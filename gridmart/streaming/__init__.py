"""Incremental refresh of the mart, driven by new bronze files."""
