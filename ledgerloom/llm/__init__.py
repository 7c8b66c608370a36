"""Operators for large text corpora. Nothing outside this folder imports it (the entry point adds it if present)."""
