"""Reusable relational operators: DataFrame in, DataFrame out."""
