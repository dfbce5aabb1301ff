"""Operators: plain functions over DataFrames, grouped by concern."""
