"""Functions of the spatial analytics engine."""
