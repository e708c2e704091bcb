"""plans of the seismic engine."""
