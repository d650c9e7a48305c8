"""Readers for landed files and the three feeds."""
