"""Operators for training-data pipelines: dedup, packing, language, toxicity, scoring, WARC, URL lists.

Nothing else in the library imports this package.
"""
