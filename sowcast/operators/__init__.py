"""Derived datasets: functions from DataFrames to a lazy DataFrame, for all
stations at once."""
