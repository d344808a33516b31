"""Operators for preparing training data: search, token counts, filters, near duplicates, packing and scoring."""
