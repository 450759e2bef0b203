"""Operators for preparing training data: quality, near copies, personal data, mixing, tokens."""
