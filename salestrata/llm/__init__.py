"""Operators for preparing training text, each over whole DataFrames of documents."""
