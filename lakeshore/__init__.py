"""A PySpark library for a retailer's layered tables: ingest, clean, classify, aggregate and report."""
