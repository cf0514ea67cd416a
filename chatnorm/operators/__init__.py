"""Operators over DataFrames: convert, de-duplicate, cap, profile columns, detect mappings."""
