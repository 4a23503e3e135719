"""Operators for large text corpora: one module per operator, bound to the test tables in ``queries``."""
