"""Operators for preparing training data: archives, mixing, scans, near-duplicates, scoring.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
