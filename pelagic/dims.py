"""Small dimensions: regions, variables and sources (fixed values)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Region names in the order of region_id: south then north, west to east.
REGIONS = ("SOUTH_PACIFIC_WEST", "SOUTH_PACIFIC_EAST", "SOUTH_ATLANTIC", "SOUTH_INDIAN", "NORTH_PACIFIC_WEST", "NORTH_PACIFIC_EAST", "NORTH_ATLANTIC", "NORTH_INDIAN")
#: token, source, variable, kind, offset added at ingest.
VARIABLES = (
    ("glorys_ssh", "glorys", "zos", "gridded", 0.0), ("glorys_sst", "glorys", "thetao", "gridded", 0.0), ("glorys_sss", "glorys", "so", "gridded", 0.0),
    ("glorys_uo", "glorys", "uo", "gridded", 0.0), ("glorys_vo", "glorys", "vo", "gridded", 0.0), ("l4_ssh", "l4_ssh", "sla", "gridded", 0.0),
    ("l4_sst", "l4_sst", "analysed_sst", "gridded", -273.15), ("l4_sss", "l4_sss", "sos", "gridded", 0.0), ("l4_wind", "l4_wind", "eastward_wind", "gridded", 0.0),
    ("l3_sst", "l3_sst", "adjusted_sea_surface_temperature", "gridded", 0.0), ("l3_sss_smos", "l3_sss_smos", "Sea_Surface_Salinity", "swath", 0.0),
    ("l3_sss_smos_asc", "l3_sss_smos_asc", "Sea_Surface_Salinity", "swath", 0.0), ("l3_sss_smos_desc", "l3_sss_smos_desc", "Sea_Surface_Salinity", "swath", 0.0),
    ("l3_ssh", "l3_ssh", "sla_filtered", "track", 0.0), ("l3_swot", "l3_swot", "ssha_filtered", "swath", 0.0), ("argo", "argo", "TEMP", "point", 0.0),
)


def region_boxes(spark: SparkSession) -> DataFrame:
    return spark.range(len(REGIONS)).select(
        F.col("id").cast("int").alias("region_id"), F.element_at(F.array(*map(F.lit, REGIONS)), (F.col("id") + 1).cast("int")).alias("region"),
        ((F.col("id") % 4) * 90 - 180.0).alias("r_lon_min"), ((F.col("id") % 4) * 90 - 90.0).alias("r_lon_max"),
        (F.floor(F.col("id") / 4) * 90 - 90.0).alias("r_lat_min"), (F.floor(F.col("id") / 4) * 90 - 0.0).alias("r_lat_max"),
    )


def region_name(region: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, REGIONS)), region + 1)


def source_token(name: Column) -> Column:
    """`l4_sst` and `l4_sst.nc` are the same source; a blank name is an error."""
    token = F.regexp_replace(F.trim(name), r"\.nc$", "")
    return F.when(F.length(token) > 0, token).otherwise(F.raise_error(F.lit("blank source name")))
