"""streaming of the seismic engine."""
