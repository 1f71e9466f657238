"""Operators for preparing text corpora for training.

Each takes and returns DataFrames and works on a table like ``documents`` (doc_id, text,
and any further columns). ``registry`` holds the registered queries and their SQL.
"""
