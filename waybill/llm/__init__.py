"""Operators for preparing training text: filters, deduplication, tokenisers, sketches and a pipeline."""
