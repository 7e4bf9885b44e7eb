"""Readers for the delimited feeds."""
