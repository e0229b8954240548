"""Registered queries, their fixtures and their SQL oracles."""
