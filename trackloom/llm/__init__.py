"""Operators for large text corpora: one module per operator, queries in ``queries``.

Nothing outside this subpackage imports it.
"""
