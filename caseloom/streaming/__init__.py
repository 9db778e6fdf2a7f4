"""Incremental runs driven by arriving files instead of a schedule."""
