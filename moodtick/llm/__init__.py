"""Operators of a training-data pipeline: ten operators, their queries and SQL."""
