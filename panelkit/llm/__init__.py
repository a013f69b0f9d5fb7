"""Operators for preparing training text: search, filters, deduplication, tokens, packing, language models."""
