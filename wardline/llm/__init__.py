"""Operators that prepare training text: duplicates, classifiers, mixing, tokens and shards."""
