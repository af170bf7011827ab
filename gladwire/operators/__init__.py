"""Operators: DataFrame in, DataFrame out, lazy."""
