"""File discovery and table reads and writes."""
