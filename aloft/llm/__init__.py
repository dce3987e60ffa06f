"""Operators for preparing training data, and the queries that apply them.

Nothing outside this package imports it, except the guarded registration in
``__spark_entry__.py`` and ``corpus_pipeline.py`` (which counts as part of it).
"""
