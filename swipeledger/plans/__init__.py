"""Jobs that write tables."""
