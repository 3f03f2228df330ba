"""Operators over training text: classifiers, deduplication, mixing, packing and formatting."""
