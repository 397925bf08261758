"""Operators on documents: spans, taggers, mixing, deduplication, threads, layout."""
