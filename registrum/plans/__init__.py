"""Whole-table plans."""
