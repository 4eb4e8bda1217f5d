"""Queries over tables, and workflows that chain operators."""
