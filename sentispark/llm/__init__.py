"""Operators of a training-data pipeline (one module per operator).

Nothing outside this folder imports it, apart from the guarded registration in
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
