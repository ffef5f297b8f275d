"""Silver layer: one row per zip prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.functions.columns import mean

ZIP = "geolocation_zip_code_prefix"


def _exact(coordinate: str) -> Column:
    """A decimal, whose sums do not depend on the order of the rows."""
    return F.col(coordinate).cast("decimal(28,15)")


def silver_geolocation(geolocation: DataFrame, first_by: str | None = None) -> DataFrame:
    """Centroid of every zip prefix with the city and state of one of its rows.

    City and state come from the same row: the one with the smallest
    ``first_by``, or without it the alphabetically first named place, so the choice does
    not depend on how the input is partitioned. A NULL prefix is a group.

    Rows are first reduced per place, with only numbers to aggregate, which
    hashes in place before the shuffle however many rows a prefix has; text is
    compared only over the few places of each prefix.
    """
    city, state = F.col("geolocation_city"), F.col("geolocation_state")
    first_seen = F.min(first_by) if first_by else F.lit(None).cast("long")
    places = geolocation.groupBy(ZIP, city, state).agg(
        F.sum(_exact("geolocation_lat")).alias("lat_sum"),
        F.count("geolocation_lat").alias("lat_n"),
        F.sum(_exact("geolocation_lng")).alias("lng_sum"),
        F.count("geolocation_lng").alias("lng_n"),
        first_seen.alias("first_seen"),
    )
    seen = F.col("first_seen")
    rank = F.struct(seen.isNull(), seen, city.isNull(), state.isNull(), city, state)
    place = F.min_by(F.struct(city.alias("city"), state.alias("state")), rank)
    return (
        places.groupBy(ZIP)
        .agg(
            mean(F.sum("lat_sum"), F.sum("lat_n")).alias("latitude"),
            mean(F.sum("lng_sum"), F.sum("lng_n")).alias("longitude"),
            place.alias("place"),
        )
        .select(ZIP, "latitude", "longitude", "place.city", "place.state")
    )
