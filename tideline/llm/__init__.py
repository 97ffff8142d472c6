"""Operators that prepare training data: dedup, filters, tokenizing, chat formatting, packing."""
