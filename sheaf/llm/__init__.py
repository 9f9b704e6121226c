"""Operators for cleaning and measuring training text."""
