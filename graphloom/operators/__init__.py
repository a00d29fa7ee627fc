"""Operators: functions of DataFrames."""
