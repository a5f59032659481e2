"""DataFrame -> DataFrame operators of the propensity engine."""
