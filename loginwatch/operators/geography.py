"""Great-circle distances between the countries accounts move between."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loginwatch.functions.geo import Centroids, country_km
from loginwatch.operators.impossible_travel import with_pair


def observed_pairs(transitions: DataFrame) -> DataFrame:
    """Unordered country pairs between consecutive successes, with the number of legs."""
    moved = transitions.where("prev_country IS NOT NULL AND country != prev_country")
    return with_pair(moved, "prev_country").groupBy("country_a", "country_b").agg(F.expr("count(1) AS legs"))


def country_distances(pairs: DataFrame, centroids: Centroids) -> DataFrame:
    """Centroid distance of each given pair, rounded to 50 km; unknown countries drop out.

    Extends the distance table to pairs it lacks. Pairs come from the data, so nothing
    is paired with everything.
    """
    km = country_km("country_a", "country_b", centroids)
    return pairs.selectExpr("*", f"cast(round({km} / 50) * 50 AS int) AS distance_km").where(
        "distance_km IS NOT NULL"
    )
