"""Operators of a large-scale training-data pipeline, one module each.

Nothing else in the library imports this subpackage.
"""
