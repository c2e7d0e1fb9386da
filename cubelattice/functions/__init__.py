"""Functions of the statistical-cube engine."""
