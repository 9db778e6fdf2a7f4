"""Readers of source sheets and the table store."""
