"""Vocabulary, schemas and column expressions."""
