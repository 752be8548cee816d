"""Readers, writers, dictionaries and configuration."""
