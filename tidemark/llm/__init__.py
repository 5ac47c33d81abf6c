"""Operators for preparing training data: packing, scoring, tokenizing, fingerprints,
deduplication, extraction and language identification. Nothing else in the library imports them."""
