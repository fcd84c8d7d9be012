"""Operators for large text corpora (training-data preparation).

Each module holds one operator with a general interface; ``queries.py`` holds
the thin registered queries. Nothing outside this folder (and
``corpus_pipeline.py``) imports it.
"""
