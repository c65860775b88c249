"""Operators for preparing training data, one module per operator.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames; the registered queries are in ``catalog.py``.
"""
