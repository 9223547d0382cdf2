"""Operators for training-data pipelines, their registered queries and the SQL they match."""
