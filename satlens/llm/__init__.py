"""Operators for large-scale training-data preparation (filters, joins, token files, mixing, packing)."""
