"""Prompt datasets and batch completions as Spark jobs."""
