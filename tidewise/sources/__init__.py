"""Readers: topics, stored tables, config lists, and inputs derived from the test tables."""
