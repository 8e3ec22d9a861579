"""Closed value sets, text functions and similarity."""
