"""Storage packing of variables to small integers, by rules on their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILL = -32767
#: Words in names that are kept as they are, and words in those of them that are whole numbers.
AS_IS = ("time", "date", "mask", "quality", "flag", "status", "source", "angle")
WHOLE = ("flag", "status", "source", "count", "number")
#: Fixed values for all other names: (words in the name, type, scale, offset, fill); the first rule that fits holds.
#: Salinity's short names count whole, or at an end, apart by an underscore.
RULES = (
    (("ssh", "sla", "mdt", "zos", "adt"), "int16", 0.0005, 0.0, FILL),
    (("sst", "thetao", "temperature"), "int16", 0.001, 20.0, FILL),
    (("^sss$", "^so$", "^sos$", "salinity", "^sss_", "_sss$"), "int16", 0.002, 30.0, FILL),
    (("uo", "vo", "current"), "int16", 0.001, 0.0, FILL),
    (("wind", "speed"), "int16", 0.01, 0.0, FILL),
    (("n_obs", "count"), "int16", 1.0, 0.0, -1),
    (("track", "overlap", "mask", "num"), "int8", 1.0, 0.0, -1),
)


def codec(name: Column) -> Column:
    """struct(dtype, scale, offset, fill) of a variable; float32 where no rule fits."""
    def made(dtype: str, scale: float | None = None, offset: float | None = None, fill: int | None = None) -> Column:
        return F.struct(F.lit(dtype).alias("dtype"), F.lit(scale).cast("double").alias("scale"), F.lit(offset).cast("double").alias("offset"), F.lit(fill).cast("int").alias("fill"))

    def has(words: tuple[str, ...]) -> Column:
        return F.lower(name).rlike("|".join(words))

    out = made("float32")
    for words, *rule in reversed(RULES):
        out = F.when(has(words), made(*rule)).otherwise(out)
    return F.when(has(AS_IS) & has(WHOLE), made("int16", 1.0, 0.0, FILL)).when(has(AS_IS), made("float32")).otherwise(out)


def pack(value: Column, scale: Column | float, offset: Column | float, fill: int = FILL) -> Column:
    """Rounds half to even, as arrays do."""
    return F.coalesce(F.rint((value - offset) / scale).cast("int"), F.lit(fill))


def unpack(packed: Column, scale: Column | float, offset: Column | float, fill: int = FILL) -> Column:
    return F.when(packed != fill, packed * scale + offset)


def range_check(cells: DataFrame, variable: str = "variable", value: str = "val") -> DataFrame:
    """Whether each variable's values fit the packed range."""
    d = cells.groupBy(variable).agg(F.min(value).alias("low"), F.max(value).alias("high")).withColumn("c", codec(F.col(variable)))
    reach = F.col("c.scale") * 32760
    return d.select(variable, "low", "high", F.when(F.col("c.scale").isNull(), F.lit(True)).otherwise((F.col("low") >= F.col("c.offset") - reach) & (F.col("high") <= F.col("c.offset") + reach)).alias("is_safe"))


def kelvin_to_celsius(frame: DataFrame, keys: tuple[str, ...], value: str, variable: str) -> DataFrame:
    """Temperature-like fields with a mean above 200 are in Kelvin; names of metadata are left alone."""
    mean = frame.groupBy(*keys).agg(F.avg(value).alias("__mean"))
    warm = F.lower(F.col(variable)).rlike("sst|temp|thetao") & ~F.lower(F.col(variable)).rlike("error|flag|quality|mask|count|time")
    return frame.join(mean, list(keys)).withColumn(value, F.when(warm & (F.col("__mean") > 200), F.col(value) - 273.15).otherwise(F.col(value))).drop("__mean")
