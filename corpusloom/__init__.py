"""Prompt-corpus planning, sampling, scoring and reporting on Spark DataFrames."""
