"""Operators for preparing training text: scans, tokenization, dedup, mixing and quality."""
