"""Readers, writers, fixed reference values and the demo login log."""
