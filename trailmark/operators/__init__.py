"""Batch operators: functions from DataFrames to DataFrames, lazy, without UDFs."""
