"""Operators of a training-data pipeline: deduplication, decontamination, filters, classifiers, tokens."""
