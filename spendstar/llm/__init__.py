"""Operators for preparing training text at scale.

Nothing else in the library imports this subpackage. ``queries`` and ``sql``
hold the registered queries; every operator lives in a module of its own and
takes and returns DataFrames.
"""
