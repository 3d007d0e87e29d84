"""Readers: CSV files, existing targets, table folders and their log files."""
