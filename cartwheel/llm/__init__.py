"""Operators for preparing training data: one module per operator.

Nothing else in the library imports this subpackage. ``queries`` holds the
registered query of every operator and the SQL that checks it.
"""
