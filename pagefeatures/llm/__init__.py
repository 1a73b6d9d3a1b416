"""Operators of a training-data pipeline: scoring, scanning, deduplication, tokenizing and packing.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.  Every
operator takes column names as parameters and selects only the columns it
needs, so extra columns, also with clashing names, never matter.
"""
