"""Complaint analytics on Spark: landing, cleaning, identity resolution, gold tables, reports."""
