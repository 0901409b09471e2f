"""Operators for building training data: token files, deduplication, quality, licences, mixing."""
