"""Operators of a training-data pipeline over document tables, with their queries and SQL."""
