"""Operators of a training-data pipeline: filtering, deduplication, mixing, token output.

Nothing outside this subpackage imports it, except the guarded registration in
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
