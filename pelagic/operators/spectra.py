"""Power spectra. Transforms run as grouped-map functions on one bounded segment, row or field at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .matching import bilinear, right_neighbour
from .tracks import qualified_segments, with_segments, with_steps


def psd_1d(values: np.ndarray, dx: float, min_points: int = 50, min_bins: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """One-sided spectrum of a line: linear trend off, Hann window, Parseval scaling; empty where too short.

    The last wavenumber of an even length stands for itself; all others but the mean are doubled, also that of an odd length.
    """
    n = len(values)
    if n < min_points:
        return np.zeros(0), np.zeros(0)
    x = np.arange(n)
    w = np.hanning(n)
    f = np.fft.rfft((values - np.polyval(np.polyfit(x, values, 1), x)) * w)
    p = np.abs(f) ** 2 / (n**2 * np.mean(w**2)) * n * dx
    p[1 : -1 if n % 2 == 0 else None] *= 2
    k = np.fft.rfftfreq(n, dx)
    good = (k > 0) & (p > 0)
    return (k[good], p[good]) if good.sum() >= min_bins else (np.zeros(0), np.zeros(0))


def psd_2d(field: np.ndarray, dx: float, dy: float, min_valid: float = 0.85) -> tuple[np.ndarray, np.ndarray]:
    """Isotropic spectrum of a field: gaps filled with the mean, plane off, Hann windows, ring means times 2 pi k.

    Rings are a step wide, from half a step to the first edge beyond the highest wavenumber; fewer than five with power
    make no spectrum.
    """
    ny, nx = field.shape
    ok = np.isfinite(field)
    if ok.mean() < min_valid or min(nx, ny) < 4:
        return np.zeros(0), np.zeros(0)
    z = np.where(ok, field, field[ok].mean())
    for axis, n in ((0, ny), (1, nx)):  # on a whole grid the slopes of a plane do not depend on each other
        at = (np.arange(n) - (n - 1) / 2).reshape((-1, 1) if axis == 0 else (1, -1))
        z = z - at * (z * at).sum() / (at**2 * np.ones_like(z)).sum()
    z = z - z.mean()
    w = np.outer(np.hanning(ny), np.hanning(nx))
    p = np.abs(np.fft.fft2(z * w)) ** 2 * dx * dy / (nx * ny * np.mean(w**2))
    k = np.hypot(np.fft.fftfreq(nx, dx)[None, :], np.fft.fftfreq(ny, dy)[:, None])
    dk = max(1 / (nx * dx), 1 / (ny * dy))
    edges = np.arange(dk / 2, min(0.5 / dx, 0.5 / dy) + dk, dk)
    ring = np.digitize(k.ravel(), edges) - 1
    inside = (ring >= 0) & (ring < len(edges) - 1)
    n = np.bincount(ring[inside], minlength=len(edges) - 1)
    mean = np.bincount(ring[inside], p.ravel()[inside], len(edges) - 1) / np.maximum(n, 1)
    centre = (edges[:-1] + edges[1:]) / 2
    good = mean > 0
    return (centre[good], (mean * 2 * np.pi * centre)[good]) if good.sum() >= 5 else (np.zeros(0), np.zeros(0))


def zonal_psd(values: np.ndarray, dx: float, min_valid: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of a row; gaps are bridged linearly where at least half is there."""
    ok = np.isfinite(values)
    n = len(values)
    if n < 4 or ok.mean() < min_valid:
        return np.zeros(0), np.zeros(0)
    x = np.arange(n)
    v = np.interp(x, x[ok], values[ok])
    f = np.fft.rfft((v - np.polyval(np.polyfit(x, v, 1), x)) * np.hanning(n))
    return np.fft.rfftfreq(n, dx)[1:], (2 / (n * dx) * np.abs(f) ** 2)[1:]


def _fields(frame: DataFrame, keys: tuple[str, ...]) -> str:
    kinds = dict(frame.dtypes)
    return ", ".join(f"{k} {kinds[k]}" for k in keys)


def _repeated(group: pd.DataFrame, keys: tuple[str, ...], n: int) -> dict[str, pd.Series]:
    """The group's keys, n times; as objects, so that none at all has no type of its own."""
    return {c: pd.Series([group[c].iloc[0]] * n, dtype=object) for c in keys}


def line_spectra(points: DataFrame, keys: tuple[str, ...], order: str | tuple[str, ...], value: str, dx: float, min_points: int = 50) -> DataFrame:
    """(keys, k, psd) of every line: values in order (no two rows of a line alike in it, or the spectrum is not defined), gaps bridged, by psd_1d."""
    by = [order] if isinstance(order, str) else list(order)

    def run(line: pd.DataFrame) -> pd.DataFrame:
        v = line.sort_values(by, kind="stable")[value].to_numpy(float)
        ok = np.isfinite(v)
        k, p = psd_1d(np.interp(np.arange(len(v)), np.flatnonzero(ok), v[ok]), dx, min_points) if ok.sum() > 1 else (np.zeros(0), np.zeros(0))
        return pd.DataFrame({**_repeated(line, keys, len(k)), "k": k, "psd": p})

    return points.select(*keys, *by, value).groupBy(*keys).applyInPandas(lambda g: run(g), f"{_fields(points, keys)}, k double, psd double")


def grid_rows_spectra(cells: DataFrame, keys: tuple[str, ...], n_i: int, dx: float, value: str = "val") -> DataFrame:
    """Zonal spectra: a row's cells are laid out on n_i columns, transformed, and averaged over the rows of the keys."""
    def run(row: pd.DataFrame) -> pd.DataFrame:
        v = np.full(n_i, np.nan)
        v[row["i"].to_numpy(int)] = row[value].to_numpy(float)
        k, p = zonal_psd(v, dx)
        return pd.DataFrame({**_repeated(row, keys, len(k)), "bin": np.arange(len(k)), "k": k, "psd": p})

    rows = cells.select(*keys, "i", "j", value).groupBy(*keys, "j").applyInPandas(lambda g: run(g), f"{_fields(cells, keys)}, bin int, k double, psd double")
    return rows.groupBy(*keys, "bin").agg(F.first("k").alias("k"), F.avg("psd").alias("psd"), F.count(F.lit(1)).alias("n_rows"))


def field_spectra(cells: DataFrame, keys: tuple[str, ...], n_i: int, n_j: int, dx: float, dy: float, min_valid: float = 0.85, value: str = "val") -> DataFrame:
    """Isotropic spectra of whole fields of a fixed size."""
    def run(field: pd.DataFrame) -> pd.DataFrame:
        z = np.full((n_j, n_i), np.nan)
        z[field["j"].to_numpy(int), field["i"].to_numpy(int)] = field[value].to_numpy(float)
        k, p = psd_2d(z, dx, dy, min_valid)
        return pd.DataFrame({**_repeated(field, keys, len(k)), "k": k, "psd": p})

    return cells.select(*keys, "i", "j", value).groupBy(*keys).applyInPandas(lambda g: run(g), f"{_fields(cells, keys)}, k double, psd double")


def average_spectra(spectra: DataFrame, line: tuple[str, ...], over: tuple[str, ...], bins: int = 200) -> DataFrame:
    """Geometric mean of spectra on log-spaced wavenumbers, each interpolated linearly in logarithms.

    From the largest first wavenumber to the smallest last one; over the whole range where those don't meet.
    """
    d = spectra.where("k > 0 AND psd > 0").select(*line, *[c for c in over if c not in line], F.log10("k").alias("x"), F.log10("psd").alias("y"))
    ends = d.groupBy(*dict.fromkeys([*over, *line])).agg(F.min("x").alias("lo"), F.max("x").alias("hi")).groupBy(*over).agg(F.max("lo").alias("a"), F.min("hi").alias("b"), F.min("lo").alias("c"), F.max("hi").alias("d"))
    ends = ends.select(*over, F.when(F.col("a") < F.col("b"), F.col("a")).otherwise(F.col("c")).alias("x0"), F.when(F.col("a") < F.col("b"), F.col("b")).otherwise(F.col("d")).alias("x1"))
    w = Window.partitionBy(*dict.fromkeys([*over, *line])).orderBy("x")
    pieces = d.withColumn("x_next", F.lead("x").over(w)).withColumn("y_next", F.lead("y").over(w)).where("x_next > x").join(ends, list(over))
    step = (F.col("x1") - F.col("x0")) / (bins - 1)
    first, last = F.ceil((F.col("x") - F.col("x0")) / step - 1e-9), F.floor((F.col("x_next") - F.col("x0")) / step + 1e-9)
    first, last = F.greatest(first, F.lit(0)).cast("int"), F.least(last, F.lit(bins - 1)).cast("int")
    hits = pieces.withColumn("step", step).withColumn("p", first).withColumn("q", last).where("p <= q").withColumn("bin", F.explode(F.sequence("p", "q")))
    at = F.col("x0") + F.col("bin") * F.col("step")
    y = F.col("y") + (F.col("y_next") - F.col("y")) * (at - F.col("x")) / (F.col("x_next") - F.col("x"))
    one = hits.groupBy(*dict.fromkeys([*over, *line]), "bin").agg(F.min(at).alias("at"), F.min(F.struct("x", y.alias("y")))["y"].alias("y"))
    return one.groupBy(*over, "bin").agg(F.pow(F.lit(10.0), F.min("at")).alias("k"), F.pow(F.lit(10.0), F.avg("y")).alias("psd"), F.count(F.lit(1)).alias("n"))


def effective_resolution(obs: DataFrame, diff: DataFrame, keys: tuple[str, ...], limit: float = 0.5) -> DataFrame:
    """The longest scale at which the spectrum of the differences exceeds a share of that of the observations."""
    both = obs.select(*keys, "bin", "k", F.col("psd").alias("po")).join(diff.select(*keys, "bin", F.col("psd").alias("pd")), [*keys, "bin"])
    return both.where(F.col("pd") / F.col("po") > limit).groupBy(*keys).agg(F.min("k").alias("k"), (1 / F.min("k")).alias("wavelength"))


def track_spectra(obs: DataFrame, grid: DataFrame, lon0: float, lat0: float, step: float, shape: tuple[int, int], method: str = "bilinear", keys: tuple[str, ...] = ("region_id",), min_km: float = 300.0, min_points: int = 50, min_valid: float = 0.9, dx: float = 10.0, bins: int = 200) -> DataFrame:
    """Spectra of a product sampled along tracks beside those of the tracks themselves, averaged by keys, product and date.

    obs: track_id, obs_date, obs_id, lon, lat, val and the keys, for instance a region; a track's points of a day with the
    same keys are cut into segments, of which the long and whole ones count. method: bilinear, or right (the first node
    not below a point). One plan: the same segments serve both products.
    """
    if method not in ("bilinear", "right"):
        raise ValueError(f"unknown method {method}")
    line = ("track_id", "obs_date", *keys)
    segments = with_segments(with_steps(obs, line), line)
    good = qualified_segments(segments, min_km, min_points, min_valid, line).select(*line, "segment")
    kept = segments.join(good, [*line, "segment"], "left_semi")
    if method == "right":
        sampled = right_neighbour(kept, grid, lon0, lat0, step, *shape)
    else:
        at = bilinear(kept.select("obs_id", "obs_date", "lon", "lat"), grid, lon0, lat0, step).select("obs_id", "obs_date", "grid_val")
        sampled = kept.join(at, ["obs_id", "obs_date"], "left")
    products = F.explode(F.array(F.struct(F.lit("track").alias("product"), F.col("val").alias("value")), F.struct(F.lit("grid").alias("product"), F.col("grid_val").alias("value"))))
    own = (*keys, "track_id", "segment", "product", "obs_date")
    lines = line_spectra(sampled.withColumn("p", products).select(*line, "segment", "along_km", "obs_id", "p.*"), own, ("along_km", "obs_id"), "value", dx, min_points)
    return average_spectra(lines, ("track_id", "segment"), (*keys, "product", "obs_date"), bins)
