"""Sources of the statistical-cube engine."""
