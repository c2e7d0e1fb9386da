"""Streaming of the statistical-cube engine."""
