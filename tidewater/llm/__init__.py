"""Operators for large-scale training-data preparation.

Each module holds one operator with a general interface over DataFrames;
``queries`` binds them to the tables of the catalogue.  Nothing outside this
folder imports it.
"""
