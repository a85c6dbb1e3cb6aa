"""Assembled pipelines and the query registry."""
