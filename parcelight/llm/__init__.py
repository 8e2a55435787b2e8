"""Operators for preparing training text: filters, duplicates, mixing, packing."""
