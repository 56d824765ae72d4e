"""Operators for preparing language-model training data: filters, deduplication, mixing, tokens, search."""
