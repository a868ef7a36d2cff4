"""Plans of the spatial analytics engine."""
