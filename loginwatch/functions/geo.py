"""Great-circle distance from country centroids, as SQL text."""

from __future__ import annotations

from collections.abc import Mapping

EARTH_RADIUS_KM = 6371.0

Centroids = Mapping[str, tuple[float, float]]


def great_circle_km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = (
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)"
    )
    return f"{2 * EARTH_RADIUS_KM}D * asin(sqrt(least(1D, {h})))"


def centroid(country: str, centroids: Centroids, axis: int) -> str:
    """Latitude (axis 0) or longitude (axis 1) of a country; NULL when unknown."""
    cases = " ".join(f"WHEN '{code}' THEN {float(point[axis])!r}D" for code, point in centroids.items())
    return f"(CASE {country} {cases} END)"


def country_km(a: str, b: str, centroids: Centroids) -> str:
    return great_circle_km(
        centroid(a, centroids, 0), centroid(a, centroids, 1),
        centroid(b, centroids, 0), centroid(b, centroids, 1),
    )
