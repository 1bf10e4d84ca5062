"""Streams that stop and go on, rows that come late, and segments against a plain loop."""

import datetime as dt
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pelagic.streaming import jobs

SCHEMA = "obs_id long, track_id long, obs_time timestamp, lon double, lat double, val double"
START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def rows(first, n, seed):
    """Passes of three tracks along a meridian, with jumps and pauses."""
    r, out, at = random.Random(seed), [], defaultdict(lambda: [0.0, 0.0])
    for k in range(first, first + n):
        track = k % 3
        lon, lat = at[track]
        lat += r.choice([0.1, 0.1, 0.1, 0.12, 0.09, 5.0 if r.random() < 0.1 else 0.1])
        at[track] = [lon, lat if lat < 80 else -80.0]
        out.append((k, track, START + dt.timedelta(minutes=k * 7 + (600 if k % 400 > 350 else 0)), lon, at[track][1], float(k % 10)))
    return out


def put(spark, folder, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def plain_segments(data, times, idle, watermark):
    out = []
    for track in {r[1] for r in data}:
        own = sorted((r for r in data if r[1] == track and r[2] <= watermark), key=lambda r: (r[2], r[0]))
        bins, segment, number, before = Counter(), [], 0, None
        for r in own:
            step = jobs.km_between(before[3], before[4], r[3], r[4]) if before else 0.0
            if segment and step > times * jobs.median_of(bins):
                out.append((track, number, len(segment), segment[0][2], segment[-1][2]))
                number, segment = number + 1, []
            if step > 0:
                bins[jobs.step_bin(step)] += 1
            segment.append(r)
            before = r
        if segment and watermark >= segment[-1][2] + idle and not any(r[1] == track and r[2] > watermark for r in data):
            out.append((track, number, len(segment), segment[0][2], segment[-1][2]))
    return sorted(out)


def test_segments_across_a_restart(spark, tmp_path):
    data = rows(0, 900, 4)
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    put(spark, folder, data[:500])
    stream = lambda: jobs.track_segments(spark.readStream.schema(SCHEMA).parquet(folder), 3.0)
    jobs.run_available(stream(), "segments_a", "append", checkpoint)
    put(spark, folder, data[500:] + [(10_000, 7, START + dt.timedelta(days=30), 0.0, 0.0, 0.0)])  # which moves the watermark past all others
    got = jobs.run_available(stream(), "segments_b", "append", checkpoint)
    found = sorted((r["track_id"], r["segment"], r["n"], r["started"].astimezone(dt.timezone.utc), r["ended"].astimezone(dt.timezone.utc)) for r in got.collect())
    want = plain_segments(data, 3.0, dt.timedelta(hours=6), START + dt.timedelta(days=29))
    assert len(want) > 20 and found == want


def test_daily_means_and_sums_after_a_restart(spark, tmp_path):
    jobs.stateful(spark)
    data = rows(0, 1500, 9)
    late = [(20_000, 1, START, 10.0, 10.0, 5.0)]
    folder = str(tmp_path / "in")
    put(spark, folder, data[:700])
    stream = lambda: spark.readStream.schema(SCHEMA).parquet(folder)
    runs = {"append": lambda: jobs.daily_means(stream(), 90.0, 1), "update": lambda: jobs.gridded_sums(stream(), 90.0)}
    keys = {"append": (), "update": ("obs_date", "region_id", "i", "j")}
    for mode, make in runs.items():
        jobs.run_available(make(), f"first_{mode}", mode, str(tmp_path / mode), keys[mode])
    put(spark, folder, data[700:] + late)
    batch = spark.createDataFrame(data, SCHEMA)
    days = batch.groupBy(F.to_date("obs_time").alias("obs_date"), F.floor((F.col("lon") + 180) / 90).cast("int").alias("i"), F.floor((F.col("lat") + 90) / 90).cast("int").alias("j")).agg(F.sum("val").alias("total"), F.count("val").alias("n"))
    whole = {(r["obs_date"], r["i"], r["j"]): (r["total"], r["n"]) for r in days.collect()}
    means = jobs.run_available(runs["append"](), "second_append", "append", str(tmp_path / "append")).collect()
    closed = {k for k in whole if dt.datetime.combine(k[0], dt.time(), dt.timezone.utc) + dt.timedelta(days=2) <= data[-1][2]}
    assert {(r["obs_date"], r["i"], r["j"]) for r in means} == closed and len(means) == len(closed) > 3
    assert all(abs(r["value"] - whole[r["obs_date"], r["i"], r["j"]][0] / r["n"]) < 1e-9 for r in means)
    sums = jobs.run_available(runs["update"](), "second_update", "update", str(tmp_path / "update"), keys["update"]).collect()
    assert {(r["obs_date"], r["i"], r["j"]): (r["total"], r["n"]) for r in sums} == whole  # the late row is in none


def test_late_rows_are_counted(spark, tmp_path):
    folder = str(tmp_path / "in")
    put(spark, folder, rows(0, 900, 1))
    start = lambda: jobs.gridded_sums(spark.readStream.schema(SCHEMA).parquet(folder), 90.0).writeStream.outputMode("update").foreachBatch(lambda b, _: b.count()).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    start().awaitTermination()
    put(spark, folder, [(9999, 1, START, 0.0, 0.0, 1.0), (9998, 1, START, 100.0, -50.0, 1.0)])
    query = start()
    query.awaitTermination()
    assert jobs.late_rows(query) == 2


def test_running_median_of_steps():
    r = np.random.default_rng(3)
    steps, every = jobs.Steps({}), Counter()
    assert steps.median() == float("inf")
    for k, b in enumerate(r.integers(-40, 40, 500)):
        steps.add(int(b))
        every[int(b)] += 1
        if k == 250:
            steps = jobs.Steps(dict(every))
        assert steps.median() == jobs.median_of(every)


class InMemory:
    """A map, value and timers as the state's handle gives them."""

    def __init__(self):
        self.kept, self.reads, self.value, self.timers = {}, [], None, set()

    def getMapState(self, *_):  # noqa: N802
        return InMemory()

    getValueState = getMapState  # noqa: N815

    def updateValue(self, key, value):  # noqa: N802
        self.kept[key] = value

    def getValue(self, key):  # noqa: N802
        self.reads.append(key)
        return self.kept[key]

    def removeKey(self, key):  # noqa: N802
        del self.kept[key]

    def iterator(self):
        return iter(list(self.kept.items()))

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def listTimers(self):  # noqa: N802
        return list(self.timers)

    def registerTimer(self, t):  # noqa: N802
        self.timers.add(t)

    def deleteTimer(self, t):  # noqa: N802
        self.timers.discard(t)


def test_waiting_rows_are_merged_from_sorted_runs(monkeypatch):
    monkeypatch.setattr(jobs, "RUN", 100)
    monkeypatch.setattr(jobs, "BLOCK", 16)
    monkeypatch.setattr(jobs, "GIVEN", 3)
    data = [r for r in rows(0, 6000, 4) if r[1] == 0]
    mixed = [data[k] for k in np.random.default_rng(1).permutation(len(data))]
    micros = lambda t: (t - START) // dt.timedelta(microseconds=1)
    frame = lambda part: pd.DataFrame([(micros(r[2]), r[0], r[4], r[3]) for r in part], columns=["time", "id", "lat", "lon"])
    state, got, most = jobs.TrackSegments(3.0, 6 * 3_600_000), [], 0
    state.init(InMemory())
    last = max(micros(r[2]) for r in data) // 1000
    watermarks = [-1, last // 3, last // 2, last // 2, last + 7 * 3_600_000]
    for k, watermark in enumerate(watermarks):
        part = [r for r in mixed[k::4]] if k < 4 else []
        state._hold(iter([frame([r for r in part if micros(r[2]) > watermarks[k - 1] * 1000 or k == 0][i : i + 40]) for i in range(0, len(part), 40)]))
        most = max(most, len(state.blocks.kept))
        got += [tuple(x) for d in state._taken((data[0][1],), watermark) for x in d.itertuples(index=False)]
    assert most > 20 and not state.blocks.kept and not state.runs.kept
    taken, seen = [], -1
    for k, watermark in enumerate(watermarks[:4]):
        taken += [r for r in mixed[k::4] if k == 0 or micros(r[2]) > watermarks[k - 1] * 1000]
    want = plain_segments(taken, 3.0, dt.timedelta(hours=6), max(r[2] for r in data) + dt.timedelta(days=1))
    assert len(want) > 10 and sorted((x[1], x[2], x[3], x[4]) for x in got) == [(w[1], w[2], micros(w[3]), micros(w[4])) for w in want]
