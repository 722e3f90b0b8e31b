"""Operators of a training-data pipeline over documents and embeddings.

The rest of the library never imports this subpackage. Every operator takes DataFrames with the columns it
names (further columns are ignored, whatever they are called) and returns a DataFrame.
"""
