"""Jobs that read tables, run operators and write tables."""
