"""Operators of a training-data pipeline: extraction, deduplication, scoring, mixing, tokens and archives."""
