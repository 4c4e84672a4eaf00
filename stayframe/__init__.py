"""Cohort feature extraction over large event tables, on Spark DataFrames."""
