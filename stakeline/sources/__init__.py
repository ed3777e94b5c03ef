"""Readers, writers, contracts and the adapters over the test tables."""
