"""Operators over tables of records and their exploded children."""
