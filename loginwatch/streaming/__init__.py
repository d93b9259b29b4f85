"""Structured Streaming forms of the rule correlations."""
