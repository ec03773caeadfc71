"""Keyed match analytics on PySpark.

Every operator takes DataFrames and column names and returns a DataFrame, so
plans stay lazy and Catalyst sees them whole.
"""
