"""Retail analytics as lazy PySpark DataFrame functions."""
