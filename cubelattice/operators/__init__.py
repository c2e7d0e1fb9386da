"""Operators of the statistical-cube engine."""
