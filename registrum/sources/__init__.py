"""Readers: delimited text, archives, lookup files and page listings."""
