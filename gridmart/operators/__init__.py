"""Relational operators of the pipeline, as DataFrame functions."""
