"""Operators for large-scale text data. Nothing outside this subpackage imports it."""
