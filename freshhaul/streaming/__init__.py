"""Structured Streaming pipeline."""
