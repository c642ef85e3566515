"""Column-level helpers: JSON access, calendar months, text and money formats."""
