"""Operators of a training-data pipeline over the text tables.

Nothing else in the library imports this subpackage. Every operator is a
function from DataFrames to a DataFrame with its own general interface;
`tastes.llm.queries` holds the thin registered queries.
"""
