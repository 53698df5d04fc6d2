"""Operators of a training-data pipeline: filtering, deduplication, extraction, scoring and mixing."""
