"""Operators of a training-data pipeline: scoring, filtering, duplicates, archives, mixing."""
