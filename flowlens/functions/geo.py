"""Geo-point helpers for the index-facing output.

The document index stores a geo point either as ``[lon, lat]`` (array) or as
``{"lat": .., "lon": ..}`` (object).  Both are plain column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lon_lat_array(lon, lat) -> Column:
    """``[lon, lat]`` as ``array<float>`` (the geo_point array form)."""
    return F.array(_c(lon).cast("float"), _c(lat).cast("float"))


def latlon_text_to_point(text) -> Column:
    """``"lat,lon"`` text -> ``[lon, lat]`` floats; unparsable -> NULL."""
    parts = F.split(_c(text), ",")
    lat = F.trim(F.get(parts, 0)).try_cast("float")
    lon = F.trim(F.get(parts, 1)).try_cast("float")
    return F.when((F.size(parts) == 2) & lat.isNotNull() & lon.isNotNull(), F.array(lon, lat))


def geo_object(lat, lon) -> Column:
    """``struct<lat, lon>`` (the geo_point object form)."""
    return F.struct(_c(lat).cast("double").alias("lat"), _c(lon).cast("double").alias("lon"))


def geo_object_json(lat, lon, label=None, label_name: str = "region") -> Column:
    """JSON text ``{"<label_name>": label, "loc": {"lat": .., "lon": ..}}``."""
    fields = []
    if label is not None:
        fields.append(_c(label).alias(label_name))
    fields.append(geo_object(lat, lon).alias("loc"))
    return F.to_json(F.struct(*fields))
