"""Operators of a training-data pipeline.

Nothing outside this subpackage imports it.  ``llm.registry`` lists its
queries and their SQL.
"""
