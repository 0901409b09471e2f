"""Completion requests and the state of their tasks."""
