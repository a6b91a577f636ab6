"""Readers, writers and the mapping of the star-schema test tables."""
