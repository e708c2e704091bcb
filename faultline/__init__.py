"""Spark-native analytics for earthquake catalogues and strong-motion records."""

__version__ = "0.1.0"

from faultline.sources.tables import load_benchmark, load_catalog, load_event_station, load_features, load_stations  # noqa: E402

__all__ = ["load_benchmark", "load_catalog", "load_event_station", "load_features", "load_stations"]
