"""Operators for preparing training text: scans, filters, classifiers, tokens, packing, search, duplicates, shards."""
