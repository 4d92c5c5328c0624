"""Readers of CSV and fixed-width extracts, writers of the results."""
