"""Operators for text corpora: one module per operator, queries and SQL in ``catalog``.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
