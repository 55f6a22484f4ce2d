"""Operators of a training-data pipeline over a table of documents.

Every operator takes a DataFrame and the names of its columns and returns a DataFrame. Nothing else
in the library imports this package.
"""
