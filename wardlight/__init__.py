"""wardlight: Spark jobs for geotagged, multi-label citizen reports joined with weather and air quality."""

from .session import build_session

__all__ = ["build_session"]
