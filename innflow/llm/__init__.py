"""Operators of a training-data pipeline: fingerprints, privacy, packing, dedup, search, mixing, scoring, captures.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports
it.  ``queries.QUERIES`` and ``queries.ORACLE_SQL`` are what the entry module
registers.
"""
