"""operators of the seismic engine."""
