"""Whole analyses: screening, searches, cross-validation, experiments."""
