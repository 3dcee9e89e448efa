"""Operators for building training data: DataFrame in, DataFrame out.

Nothing else in the library imports this subpackage.
"""
