"""Sources of the spatial analytics engine."""
