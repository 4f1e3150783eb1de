"""Operators for large-scale training-data preparation.

One module per operator; ``queries`` holds the thin contract queries. Nothing
outside this package imports it except ``corpus_pipeline.py`` and
``__spark_entry__.py``.
"""
