"""Operators: every one maps DataFrames to DataFrames, or writes one."""
