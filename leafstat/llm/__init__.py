"""Operators for building training corpora.

Each module holds one operator with its own general interface;
``queries`` applies the operators to the supplied tables.  Nothing
outside this package imports it.
"""
