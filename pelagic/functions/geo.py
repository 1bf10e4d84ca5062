"""Column expressions for coordinates, boxes, regions and distances."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_KM = 6371.0
#: Kilometres in a degree of latitude (mean), and at the equator for the box sizes of queries.
KM_PER_DEGREE_LAT, KM_PER_DEGREE_LON, KM_PER_DEGREE_BOX = 110.574, 111.32, 111.0
#: WGS-84 semi-axes in km.
WGS84_A, WGS84_B = 6378.137, 6356.752314245
REGION_DEGREES = 90


class BBox(NamedTuple):
    """A box by name, so that no order of its sides can be mistaken."""

    lon_min: float
    lon_max: float
    lat_min: float
    lat_max: float


def clean(value: Column) -> Column:
    """NaN and infinities become NULL: Spark's aggregates take NaN for a value."""
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")), None).otherwise(value)


def lon_to_180(lon: Column) -> Column:
    """Longitude in [-180, 180)."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def region_id(lon: Column, lat: Column) -> Column:
    """0..7: eight boxes of 90 by 90 degrees, half-open; NULL on the upper edges, which belong to none."""
    inside = (lon >= -180) & (lon < 180) & (lat >= -90) & (lat < 90)
    return F.when(inside, (F.floor((lon + 180) / REGION_DEGREES) + 4 * F.floor((lat + 90) / REGION_DEGREES)).cast("int"))


def in_box(lon: Column, lat: Column, box: BBox) -> Column:
    """Closed containment; a box with lon_min > lon_max crosses the date line."""
    wide = lon.between(box.lon_min, box.lon_max) if box.lon_min <= box.lon_max else (lon >= box.lon_min) | (lon <= box.lon_max)
    return wide & lat.between(box.lat_min, box.lat_max)


def clip_to_box(lon: Column, lat: Column, box: BBox) -> tuple[Column, Column]:
    east = F.when(lon >= box.lon_min, lon).otherwise(F.least(lon, F.lit(box.lon_max)))
    lon = F.greatest(F.lit(box.lon_min), F.least(F.lit(box.lon_max), lon)) if box.lon_min <= box.lon_max else east
    return lon, F.greatest(F.lit(box.lat_min), F.least(F.lit(box.lat_max), lat))


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)
    return 2 * EARTH_KM * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def patch_degrees(value: Column, unit: str, lat: Column) -> tuple[Column, Column]:
    """(degrees of longitude, of latitude) of a patch given in degrees or kilometres at a latitude."""
    if unit == "deg":
        return value, value
    return value / (KM_PER_DEGREE_BOX * F.greatest(F.cos(F.radians(lat)), F.lit(0.1))), value / KM_PER_DEGREE_BOX


def patch_km(value: Column, unit: str) -> Column:
    return value * KM_PER_DEGREE_BOX if unit == "deg" else value


def box_iou(a: str, b: str) -> Column:
    """Intersection over union of two boxes whose columns begin with the prefixes a and b."""
    def side(prefix: str, axis: str, end: str) -> Column:
        return F.col(f"{prefix}{axis}_{end}")

    def length(axis: str) -> Column:
        return F.greatest(F.lit(0.0), F.least(side(a, axis, "max"), side(b, axis, "max")) - F.greatest(side(a, axis, "min"), side(b, axis, "min")))

    def area(p: str) -> Column:
        return (side(p, "lon", "max") - side(p, "lon", "min")) * (side(p, "lat", "max") - side(p, "lat", "min"))

    both = length("lon") * length("lat")
    return F.when(area(a) + area(b) - both > 0, both / (area(a) + area(b) - both)).otherwise(F.lit(0.0))


def clamp_to_globe(lon_min: Column, lon_max: Column, lat_min: Column, lat_max: Column) -> tuple[Column, ...]:
    return F.greatest(lon_min, F.lit(-180.0)), F.least(lon_max, F.lit(180.0)), F.greatest(lat_min, F.lit(-90.0)), F.least(lat_max, F.lit(90.0))


def cell_index(value: Column, first_edge: float, step: float, n: int) -> Column:
    """Index of the half-open cell that holds value, the last one closed; NULL outside."""
    at = F.floor((value - first_edge) / step).cast("int")
    last = (at == n) & (value == first_edge + n * step)
    return F.when(last, F.lit(n - 1)).when((at >= 0) & (at < n), at)


def bin_left(value: Column, first: float, step: float, n: int) -> Column:
    """Left-closed bins, with what lies outside in the outermost ones."""
    return F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor((value - first) / step).cast("int")))


def bin_right(value: Column, first: float, step: float, n: int) -> Column:
    """Right-closed bins; NULL outside (first itself included)."""
    at = (F.ceil((value - first) / step) - 1).cast("int")
    return F.when((at >= 0) & (at < n), at)


def degrees_of_km(km: float, lat: float) -> tuple[float, float]:
    """(longitude, latitude) step of a grid of so many km at a latitude on the ellipsoid."""
    from math import cos, pi, radians, sin, sqrt

    e2 = 1 - (WGS84_B / WGS84_A) ** 2
    s = 1 - e2 * sin(radians(lat)) ** 2
    return km / (pi / 180 * WGS84_A / sqrt(s) * cos(radians(lat))), km / (pi / 180 * WGS84_A * (1 - e2) / s**1.5)


def grid_specs(regions: DataFrame, km: float, mode: str = "whole") -> DataFrame:
    """Grids of so many km for regions (r_lon_min ... r_lat_max), at their middle latitude on the ellipsoid: steps, numbers of cells, first edges.

    whole: cells begin at the lower bound and cover the region, so that every point has one cell of one region. centres:
    cell centres from the lower bound, below the upper one, so that the first edge lies half a step below, and points
    above the last edge have no cell.
    """
    if mode not in ("whole", "centres"):
        raise ValueError(f"unknown mode {mode}")
    e2 = 1 - (WGS84_B / WGS84_A) ** 2
    middle = F.radians((F.col("r_lat_min") + F.col("r_lat_max")) / 2)
    s = 1 - e2 * F.pow(F.sin(middle), 2)
    d = regions.withColumns({"lon_step": km / (F.radians(F.lit(1.0)) * WGS84_A / F.sqrt(s) * F.cos(middle)), "lat_step": km / (F.radians(F.lit(1.0)) * WGS84_A * (1 - e2) / F.pow(s, 1.5))})
    for axis in ("lon", "lat"):
        low, high, step = (F.col(c) for c in (f"r_{axis}_min", f"r_{axis}_max", f"{axis}_step"))
        d = d.withColumns({f"n_{axis}": F.ceil((high - low) / step).cast("int"), f"{axis}_edge": low - step / 2 if mode == "centres" else low})
    return d.select("region_id", *[c for axis in ("lon", "lat") for c in (f"{axis}_step", f"n_{axis}", f"{axis}_edge")])


def on_regional_grid(points: DataFrame, specs: DataFrame) -> DataFrame:
    """Points with the cell (gi, gj) of their region's own grid; those beyond its last edge are dropped. Eight grids are broadcast."""
    d = points.withColumn("region_id", region_id(F.col("lon"), F.col("lat"))).join(F.broadcast(specs), "region_id")
    d = d.withColumns({"gi": F.floor((F.col("lon") - F.col("lon_edge")) / F.col("lon_step")).cast("int"), "gj": F.floor((F.col("lat") - F.col("lat_edge")) / F.col("lat_step")).cast("int")})
    return d.where((F.col("gi") < F.col("n_lon")) & (F.col("gj") < F.col("n_lat"))).drop(*[c for c in specs.columns if c != "region_id"])
