"""functions of the seismic engine."""
