"""Operators: functions from DataFrames to DataFrames, metrics and fitted models."""
