"""Writers: topics and keyed document tables."""
