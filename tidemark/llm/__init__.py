"""Operators for large text and vector corpora. Nothing outside this folder imports it."""
