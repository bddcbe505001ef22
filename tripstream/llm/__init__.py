"""Operators of a training-data pipeline: scoring, filtering, extraction,
tokenization and deduplication of text tables.

Nothing else in the library imports this subpackage; its queries are in
``llm.queries`` and the five-stage pipeline in ``corpus_pipeline.py``.
"""
