"""Operators on tables: latest rows, upserts, quality rules, layout."""
