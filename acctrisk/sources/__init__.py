"""Readers of the input files and writers of the results."""
