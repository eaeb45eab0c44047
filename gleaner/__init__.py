"""Spark-native analytics operators: each is a function from DataFrames to a DataFrame."""
