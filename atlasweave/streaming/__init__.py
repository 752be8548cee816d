"""Matching a stream against a static table."""
