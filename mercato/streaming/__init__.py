"""Streaming entry points: the batch operators applied to file streams."""
