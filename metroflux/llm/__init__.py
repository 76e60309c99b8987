"""Operators of a training-data pipeline: language ID, BPE, packing, dedup, quality, PII, HTML, sharding."""
