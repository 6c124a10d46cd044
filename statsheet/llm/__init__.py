"""Operators of a large-scale training-data pipeline.

One module per operator; ``queries`` registers the ``opN_*`` queries and their
SQL.  Nothing else in the library imports this subpackage.
"""
