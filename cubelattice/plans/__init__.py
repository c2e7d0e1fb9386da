"""Plans of the statistical-cube engine."""
