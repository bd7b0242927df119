"""Transformations between raw, conformed and dashboard tables, and reports."""
