"""Warehouse building blocks on PySpark: clean, version, key, model, report."""
