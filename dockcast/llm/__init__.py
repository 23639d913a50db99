"""Operators for training-data pipelines: one module per operator, each with its own method.

Nothing else in the library imports this subpackage. ``queries`` registers one query per operator.
"""
