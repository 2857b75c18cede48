"""Operators for large training-data pipelines.

One module per operator, each a function from DataFrames to DataFrames;
``queries`` registers one digest query per operator with its production
parameters. Nothing outside this subpackage imports it.
"""
