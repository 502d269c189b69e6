"""Operators for preparing training data from large document tables. Nothing outside this package imports it."""
