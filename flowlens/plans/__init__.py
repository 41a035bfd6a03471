"""Composed plans and the query registry."""
