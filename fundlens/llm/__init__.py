"""Operators of a training-data pipeline: dedup, PII, decontamination,
extraction, similarity join, toxicity, quality, token counts, sharding, BPE.

Nothing else in the library imports this subpackage.
"""
