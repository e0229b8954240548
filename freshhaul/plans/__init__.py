"""Composite batch jobs."""
