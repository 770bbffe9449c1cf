"""Operators for large-scale training-data preparation.

Thirteen operators (one module each) plus the queries that apply them to whole
tables. Nothing outside this package imports it.
"""
