"""Structured Streaming forms of the daily jobs. Each takes a streaming frame and returns one, with the batch expressions.

Rows older than the watermark are dropped by Spark (late_rows counts them); state is bounded by it. upsert_batches merges a batch into the
(source, date) partitions that it brings, so that what comes late joins what is there.
"""

from __future__ import annotations

from collections import Counter
from heapq import merge
from math import asin, cos, exp, floor, log, radians, sin, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.geo import EARTH_KM, clean, region_id

#: Width of a bin of steps, in their logarithm.
STEP_BIN = 0.02


def timed(stream: DataFrame, delay: str = "1 day", time: str = "obs_time") -> DataFrame:
    """With a proper timestamp and a watermark."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def cells_of(stream: DataFrame, step: float) -> DataFrame:
    return stream.withColumns({"region_id": region_id(F.col("lon"), F.col("lat")), "i": F.floor((F.col("lon") + 180) / step).cast("int"), "j": F.floor((F.col("lat") + 90) / step).cast("int")})


def daily_means(stream: DataFrame, step: float, hours: int = 24, delay: str = "1 day", value: str = "val") -> DataFrame:
    """Tumbling daily means by cell, with a bit set of the hours seen, so that a gate on whole days can follow."""
    d = cells_of(timed(stream, delay), step).withColumn("hour_bit", F.expr("shiftleft(1, hour(obs_time))"))
    out = d.groupBy(F.window("obs_time", "1 day").alias("w"), "i", "j").agg(F.avg(value).alias("value"), F.count(value).alias("n"), F.bit_count(F.bit_or("hour_bit")).alias("n_hours"))
    return out.select(F.col("w.start").cast("date").alias("obs_date"), "i", "j", "value", "n", (F.col("n_hours") >= hours).alias("is_complete"))


def gridded_sums(stream: DataFrame, step: float, delay: str = "1 day", value: str = "val") -> DataFrame:
    """Running sums and counts by day and cell, in update mode."""
    d = cells_of(timed(stream, delay).withColumn(value, clean(F.col(value))), step).where(F.col("region_id").isNotNull())
    out = d.groupBy(F.window("obs_time", "1 day").alias("w"), "region_id", "i", "j").agg(F.sum(value).alias("total"), F.count(value).alias("n"))
    return out.select(F.col("w.start").cast("date").alias("obs_date"), "region_id", "i", "j", "total", "n")


def without_repeats(files: DataFrame, key: str = "relative_path", delay: str = "7 days", time: str = "seen_at") -> DataFrame:
    """Files whose path came before, within the watermark, are dropped."""
    return timed(files, delay, time).dropDuplicatesWithinWatermark([key])


def matched_to_grid(stream: DataFrame, grid: DataFrame, step: float) -> DataFrame:
    """Observations with the value of a static grid's cell on their day."""
    d = cells_of(stream, step).withColumn("obs_date", F.to_date("obs_time"))
    return d.join(grid.select("obs_date", "i", "j", F.col("val").alias("grid_val")), ["obs_date", "i", "j"], "left")


def track_sessions(stream: DataFrame, gap: str = "30 minutes", delay: str = "1 day", track: str = "track_id") -> DataFrame:
    """Passes of a track: a longer pause begins a new one."""
    d = timed(stream, delay).groupBy(F.session_window("obs_time", gap).alias("w"), track).agg(F.count(F.lit(1)).alias("n"), F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"))
    return d.select(track, F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "n", "lat_min", "lat_max")


def stateful(spark: SparkSession) -> None:
    """State in RocksDB, with changelogs in the checkpoint: it may outgrow memory, and a stopped query goes on where it was."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


#: Rows that wait, as they are kept; rows sorted at once, of a block read at once, and of segments given at once.
ROW = np.dtype([("time", "<i8"), ("id", "<i8"), ("lat", "<f8"), ("lon", "<f8")])
RUN, BLOCK, GIVEN = 131_072, 2_048, 10_000


class TrackSegments(StatefulProcessor):
    """Segments of a track in the order of time: a step longer than `times` the median of the positive steps so far begins a new one.

    A row waits until the watermark has passed it, so that rows are taken in order however they came. What waits is kept in
    sorted runs of some RUN rows, in blocks, and merged block by block: a worker holds a run and a block of each other one, however
    many rows a track has. Runs with room for each other become one. The steps so far are
    a histogram by their logarithm (some percent wide), so that the state of a track is bounded by what waits. A segment is
    given once: when the next one begins, or, if no row came for `idle`, by a timer.
    """

    def __init__(self, times: float, idle_ms: int) -> None:
        self.times, self.idle_ms = times, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getMapState("runs", "run int", "block int, blocks int, skip int, n long, low long")  # what is left: from a row of a block on
        self.blocks = handle.getMapState("blocks", "run int, block int", "rows binary")
        self.open = handle.getValueState("open", "number int, n long, first long, last long, lat double, lon double, lat_min double, lat_max double")
        self.steps = handle.getMapState("steps", "bin int", "n long")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        self._hold(rows)
        return self._taken(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        return self._taken(key, timerValues.getCurrentWatermarkInMs())

    def _held(self) -> dict[int, tuple]:
        return {k[0]: tuple(v) for k, v in self.runs.iterator()}

    def _hold(self, frames) -> None:
        new, n = [], 0
        for frame in frames:
            rows = np.empty(len(frame), ROW)
            for c in ROW.names:
                rows[c] = frame[c].to_numpy()
            new.append(rows)
            n += len(rows)
            if n >= RUN:
                self._keep(new)
                new, n = [], 0
        if not n:
            return
        for run, left in sorted(self._held().items(), key=lambda r: r[1][3]):
            if n + left[3] > RUN:
                break
            new += [np.frombuffer(b, ROW) for b in self._blocks_of(run, *left[:3])]
            n += left[3]
            self.runs.removeKey((run,))
        self._keep(new)

    def _keep(self, arrays: list[np.ndarray]) -> None:
        rows = np.concatenate(arrays)
        rows = rows[np.lexsort([rows[c] for c in reversed(ROW.names)])]
        run, blocks = max(self._held(), default=-1) + 1, -(-len(rows) // BLOCK)
        for k in range(blocks):
            self.blocks.updateValue((run, k), (rows[k * BLOCK : (k + 1) * BLOCK].tobytes(),))
        self.runs.updateValue((run,), (0, blocks, 0, len(rows), int(rows["time"][0])))

    def _blocks_of(self, run: int, block: int, blocks: int, skip: int):
        """What is left of a run, block by block; each goes from the state when the next one is asked for."""
        for k in range(block, blocks):
            yield bytes(self.blocks.getValue((run, k))[0])[(skip if k == block else 0) * ROW.itemsize :]
            self.blocks.removeKey((run, k))

    def _ready(self, run: int, left: tuple, limit: int):
        """Rows of a run up to a time; what is left of it then is noted."""
        block, blocks, skip, n, _ = left
        for data in self._blocks_of(run, block, blocks, skip):
            for k, row in enumerate(np.frombuffer(data, ROW).tolist()):
                if row[0] > limit:
                    self.runs.updateValue((run,), (block, blocks, skip + k, n - k, row[0]))
                    return
                yield row
            block, skip, n = block + 1, 0, n - len(data) // ROW.itemsize
        self.runs.removeKey((run,))

    def _taken(self, key, watermark):
        limit = watermark * 1000
        segment = list(self.open.get()) if self.open.exists() else None
        steps = Steps({b[0]: n[0] for b, n in self.steps.iterator()})
        columns, out = ["track_id", "segment", "n", "started", "ended", "lat_min", "lat_max"], []
        for time, _, lat, lon in merge(*[self._ready(run, left, limit) for run, left in self._held().items() if left[4] <= limit]):
            step = km_between(segment[5], segment[4], lon, lat) if segment else 0.0
            if segment and step > self.times * steps.median():
                out.append([key[0], *segment[:4], *segment[6:]])
                segment = [segment[0] + 1, 0, time, time, lat, lon, lat, lat]
                if len(out) == GIVEN:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            if step > 0:
                steps.add(step_bin(step))
            segment = segment or [0, 0, time, time, lat, lon, lat, lat]
            segment = [segment[0], segment[1] + 1, segment[2], time, lat, lon, min(segment[6], lat), max(segment[7], lat)]
        later = min((left[4] for left in self._held().values()), default=None)
        if segment and segment[1] and later is None and limit >= segment[3] + self.idle_ms * 1000:
            out.append([key[0], *segment[:4], *segment[6:]])
            segment = [segment[0] + 1, 0, *segment[2:]]
        for b in steps.changed:
            self.steps.updateValue((b,), (steps.bins[b],))
        if segment:
            self.open.update(tuple(segment))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if later is not None:
            self.handle.registerTimer(max(watermark + 1, later // 1000 + 1))
        elif segment and segment[1]:
            self.handle.registerTimer(max(watermark + 1, segment[3] // 1000 + self.idle_ms))
        yield pd.DataFrame(out, columns=columns)

    def close(self) -> None:
        pass


def km_between(lon_a: float, lat_a: float, lon_b: float, lat_b: float) -> float:
    """The great-circle distance of functions.geo.haversine_km, for two points."""
    x = sin(radians(lat_b - lat_a) / 2) ** 2 + cos(radians(lat_a)) * cos(radians(lat_b)) * sin(radians(lon_b - lon_a) / 2) ** 2
    return 2 * EARTH_KM * asin(min(1.0, sqrt(x)))


def step_bin(step: float) -> int:
    return floor(log(step) / STEP_BIN)


def median_of(bins: Counter) -> float:
    """The upper end of the bin in which the middle of the steps lies; infinite while there are none."""
    half, so_far = (bins.total() + 1) // 2, 0
    for b in sorted(bins):
        so_far += bins[b]
        if so_far >= half:
            return exp((b + 1) * STEP_BIN)
    return float("inf")


class Steps:
    """A histogram of steps whose median (median_of) is kept up to date."""

    def __init__(self, bins: dict[int, int]) -> None:
        self.bins, self.changed = Counter(bins), set()
        self.total, self.at, self.below = self.bins.total(), min(bins, default=None), 0  # below: steps in bins before `at`

    def add(self, b: int) -> None:
        self.bins[b] += 1
        self.changed.add(b)
        self.total += 1
        if self.at is None:
            self.at = b
        elif b < self.at:
            self.below += 1

    def median(self) -> float:
        if not self.total:
            return float("inf")
        half = (self.total + 1) // 2
        while self.below >= half:
            self.at -= 1
            self.below -= self.bins.get(self.at, 0)
        while self.below + self.bins.get(self.at, 0) < half:
            self.below += self.bins.get(self.at, 0)
            self.at += 1
        return exp((self.at + 1) * STEP_BIN)


def track_segments(stream: DataFrame, times: float = 3.0, idle: str = "6 hours", delay: str = "1 day", track: str = "track_id", id_: str = "obs_id") -> DataFrame:
    """(track, segment, n, started, ended, lat_min, lat_max) of every segment that is over, in append mode (see TrackSegments)."""
    stateful(stream.sparkSession)
    d = timed(stream, delay).select(track, "obs_time", F.unix_micros("obs_time").alias("time"), F.col(id_).alias("id"), "lat", "lon")
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    kind = stream.schema[track].dataType.simpleString()
    out = d.groupBy(track).transformWithStateInPandas(TrackSegments(times, idle_ms), f"track_id {kind}, segment int, n long, started long, ended long, lat_min double, lat_max double", "append", "eventTime")
    return out.select(F.col("track_id").alias(track), "segment", "n", F.timestamp_micros("started").alias("started"), F.timestamp_micros("ended").alias("ended"), "lat_min", "lat_max")


def sliding_means(stream: DataFrame, days: int, step: float, delay: str = "1 day", value: str = "val") -> DataFrame:
    """Means over windows of so many days that begin every day."""
    d = cells_of(timed(stream, delay), step).groupBy(F.window("obs_time", f"{days} days", "1 day").alias("w"), "i", "j").agg(F.avg(value).alias("value"), F.count(value).alias("n"))
    return d.select(F.col("w.start").cast("date").alias("first_date"), "i", "j", "value", "n")


def online_moments(stream: DataFrame, keys: tuple[str, ...], value: str = "val") -> DataFrame:
    """Mean, population spread, extremes and count so far, in complete mode."""
    return stream.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"), F.count(value).alias("count"))


def upsert_batches(stream: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...] = ("source_id", "obs_date")) -> StreamingQuery:
    """Merges, batch by batch, into the partitions (source, date) that a batch brings; running it again changes nothing.

    A row of a batch replaces that of the same file_id in its partition, other rows stay. The merged partitions are
    written beside the table first, so that no file is read while it is replaced.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark, new = batch.sparkSession, batch.dropDuplicates([*keys, "file_id"])
        spark.createDataFrame([], batch.schema).write.mode("append").partitionBy(*keys).parquet(path)  # there from the start
        there = spark.read.schema(batch.schema).parquet(path).join(new.select(*keys).distinct(), list(keys), "left_semi")
        merged = there.join(new, [*keys, "file_id"], "left_anti").unionByName(new)
        beside = f"{checkpoint}-merged/{number}"
        merged.write.mode("overwrite").parquet(beside)
        whole = spark.read.schema(batch.schema).parquet(beside)
        whole.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark had passed them and were left out (of an aggregate: what tasks made of them), over the batches that the query remembers."""
    return sum(int(o.numRowsDroppedByWatermark) for progress in query.recentProgress for o in progress.stateOperators)


def run_available(stream: DataFrame, name: str, mode: str, checkpoint: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Runs over what is there and returns the result, written as Parquet beside the checkpoint: for checks against the batch form.

    Running it again with the same checkpoint goes on with what came since. mode: append; update, of which the last row of each of the keys counts; or complete, whose last result counts.
    """
    path = f"{checkpoint}-result"
    stream.sparkSession.createDataFrame([], stream.schema).write.mode("ignore").parquet(path)  # there if no batch comes; a later run adds to it
    if mode == "append":
        sink = stream.writeStream.format("parquet").option("path", path)
    elif mode == "update":
        sink = stream.writeStream.foreachBatch(lambda batch, number: batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(path))
    else:
        sink = stream.writeStream.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path))
    sink.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    if mode == "update":
        found = stream.sparkSession.read.schema(T.StructType([*stream.schema.fields, T.StructField("batch", T.IntegerType())])).parquet(path)
        last = F.max_by(F.struct(*[c for c in stream.columns if c not in keys]), "batch").alias("last")
        return found.groupBy(*keys).agg(last).select(*keys, "last.*").select(*stream.columns)
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
