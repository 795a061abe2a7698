"""Event banks, row events and running sales metrics."""
