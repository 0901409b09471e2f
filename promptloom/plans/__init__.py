"""Whole jobs, from dataset to result."""
