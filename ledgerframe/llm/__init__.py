"""Operators for preparing training data at scale: one module per operator.

Nothing else in the library imports this subpackage. ``queries`` registers them.
"""
