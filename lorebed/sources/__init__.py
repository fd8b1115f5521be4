"""Readers, writers, configuration and search providers."""
