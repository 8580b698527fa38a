from pointloom.functions.geometry import (
    EARTH_RADIUS_KM,
    column,
    haversine_km,
    magnitude,
    quoted,
    squared_distance,
)

__all__ = ["EARTH_RADIUS_KM", "column", "haversine_km", "magnitude", "quoted", "squared_distance"]
