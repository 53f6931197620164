"""Operators for preparing language-model training data.

Nothing outside this folder imports it.  Each operator module has a general interface
(DataFrames in, DataFrames out); ``queries`` applies them to the standard tables.
"""
