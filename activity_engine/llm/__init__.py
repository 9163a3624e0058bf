"""Corpus operators for training-data pipelines (no other part of the library imports them)."""
