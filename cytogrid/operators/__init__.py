"""Operators of the spatial analytics engine."""
