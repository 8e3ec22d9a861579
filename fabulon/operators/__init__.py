"""Operators: functions from DataFrames to DataFrames, for many documents at once."""
