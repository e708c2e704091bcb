"""sources of the seismic engine."""
