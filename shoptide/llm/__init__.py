"""Operators of a training-data pipeline: filtering, near-duplicates, decontamination, packing, extraction, search."""
