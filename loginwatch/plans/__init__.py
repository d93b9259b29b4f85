"""Whole hunts: the operators wired together, reports, and the query registry."""
