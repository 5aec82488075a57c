"""Operators: functions from DataFrames (and explicit clock values) to a DataFrame."""
