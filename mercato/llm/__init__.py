"""Operators for preparing large text corpora: dedup, sharding, archives, filters, tokenisation."""
