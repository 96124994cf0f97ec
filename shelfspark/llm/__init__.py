"""Operators of a training-data pipeline over ``documents``-like tables.

Every operator is a function over DataFrames with documented parameters; the registered
queries are in :mod:`shelfspark.llm.queries`.  Nothing outside this folder imports it."""
