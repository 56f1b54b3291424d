"""Operators for preparing text corpora: language, truncation, leakage, survivorship,
repetition, tokens, packing and splitting.  Nothing outside this package imports it."""
