"""Reusable operators over cohort and event DataFrames."""
