"""Query boxes: generation, land fractions, overlap, and joins of boxes with cells."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, cos, radians

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.geo import KM_PER_DEGREE_BOX, box_iou, clamp_to_globe, patch_degrees
from ..sources.tables import written

#: Degrees of a tile by which boxes and points are brought together: a range join would compare all pairs.
TILE = 5.0
MASK_STEP = 0.25


#: The sides and dates of a box.
BOX = ("lon_min", "lon_max", "lat_min", "lat_max", "date_start", "date_end")
#: Members of a class of equal boxes in one row; bytes of members that are broadcast.
CHUNK, BROADCAST_MEMBERS = 4096, 64_000_000


def equal_boxes(boxes: DataFrame) -> DataFrame:
    """A row per class of boxes with the same sides and dates: these, the smallest query_id, and n_boxes."""
    return boxes.groupBy(*BOX).agg(F.min("query_id").alias("query_id"), F.count(F.lit(1)).alias("n_boxes"))


def class_members(boxes: DataFrame, classes: DataFrame, *keep: str) -> DataFrame:
    """(class_id, members) of equal_boxes, members as (query_id, those of `keep`) in arrays of some CHUNK at most."""
    named = classes.select(*[F.col(c).alias(f"__{c}") for c in BOX], F.col("query_id").alias("class_id"), "n_boxes")
    same = boxes.select("query_id", *keep, *BOX).join(named, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in BOX])
    part = F.pmod(F.xxhash64("query_id"), F.ceil(F.col("n_boxes") / CHUNK)).alias("__part")
    return same.groupBy("class_id", part).agg(F.collect_list(F.struct("query_id", *keep)).alias("members")).drop("__part")


def _repeats(classes: DataFrame) -> tuple[bool, bool]:
    """Whether a box occurs twice or more on average, and whether the members of all classes may be broadcast."""
    n, m = classes.agg(F.coalesce(F.sum("n_boxes"), F.lit(0)), F.count(F.lit(1))).first()
    return m > 0 and n >= 2 * m, 64 * m + 8 * n <= BROADCAST_MEMBERS


def for_equal_boxes(boxes: DataFrame, run: Callable[[DataFrame], DataFrame], *keep: str) -> DataFrame:
    """run(boxes), rows by query_id, with the columns `keep` of the boxes: where boxes repeat, run sees one of each class, and its rows go to all members."""
    classes = equal_boxes(boxes)
    repeats, small = _repeats(classes)
    if not repeats:
        found = run(boxes)
        return found.join(boxes.select("query_id", *keep), "query_id") if keep else found
    members = class_members(boxes, classes, *keep)
    found = run(classes.drop("n_boxes"))
    others = [c for c in found.columns if c != "query_id"]
    both = found.withColumnRenamed("query_id", "class_id").join(F.broadcast(members) if small else members, "class_id")
    return both.select(F.explode("members").alias("__m"), *others).select("__m.query_id", *others, *[f"__m.{c}" for c in keep])


def spread(frame: DataFrame, *keys: str) -> DataFrame:
    """By these keys over four tasks a core at least, however few bytes there are: for small rows that become many."""
    spark = frame.sparkSession
    return frame.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), *keys)


def exploded_tiles(boxes: DataFrame, step: float = TILE) -> DataFrame:
    """A row per box and tile that it touches."""
    def span(axis: str, low: float) -> Column:
        return F.sequence(F.floor((F.col(f"{axis}_min") - low) / step).cast("int"), F.floor((F.col(f"{axis}_max") - low) / step).cast("int"))

    return boxes.withColumn("tile_i", F.explode(span("lon", -180.0))).withColumn("tile_j", F.explode(span("lat", -90.0)))


def exploded_days(boxes: DataFrame) -> DataFrame:
    return boxes.withColumn("obs_date", F.explode(F.sequence("date_start", "date_end", F.expr("INTERVAL 1 DAY"))))


def boxes_points(boxes: DataFrame, points: DataFrame) -> DataFrame:
    """Points inside boxes (closed) on their dates: an equi-join on date and tile, then the exact test.

    Merged, never broadcast: the planner knows the boxes' size only before they are spread over days and tiles, and a
    task should meet few tiles, so that what it groups by box stays small.
    """
    tiled = points.withColumns({"tile_i": F.floor((F.col("lon") + 180) / TILE).cast("int"), "tile_j": F.floor((F.col("lat") + 90) / TILE).cast("int")})
    both = exploded_tiles(exploded_days(boxes)).hint("merge").join(tiled, ["obs_date", "tile_i", "tile_j"])
    return both.where(F.col("lon").between(F.col("lon_min"), F.col("lon_max")) & F.col("lat").between(F.col("lat_min"), F.col("lat_max"))).drop("tile_i", "tile_j")


#: Points that a tile may hold before it is cut in four; cuts at most; split tiles that are broadcast.
TILE_POINTS, TILE_CUTS, BROADCAST_SPLITS = 200_000, 5, 100_000


def _tile_of(column: str, low: float, cuts: int) -> Column:
    return F.floor((F.col(column) - low) / (TILE / 2**cuts)).cast("int")


def split_tiles(points: DataFrame, most: int = TILE_POINTS, cuts: int = TILE_CUTS) -> DataFrame:
    """(obs_date, cut, tile_i, tile_j, parts): tiles with more than `most` points, which are cut in four (parts 1), or, once
    they can't be cut any more, dealt into parts by a hash of their rows. Points are counted once, by the finest tiles."""
    fine = points.groupBy("obs_date", _tile_of("lon", -180.0, cuts).alias("fi"), _tile_of("lat", -90.0, cuts).alias("fj")).agg(F.count(F.lit(1)).alias("n"))
    levels = F.explode(F.transform(F.sequence(F.lit(0), F.lit(cuts)), lambda c: F.struct(c.alias("cut"), F.floor(F.col("fi") / F.pow(F.lit(2.0), cuts - c)).cast("int").alias("tile_i"), F.floor(F.col("fj") / F.pow(F.lit(2.0), cuts - c)).cast("int").alias("tile_j"))))
    sums = fine.select("obs_date", "n", levels.alias("t")).groupBy("obs_date", "t.cut", "t.tile_i", "t.tile_j").agg(F.sum("n").alias("n")).where(F.col("n") > most)
    return sums.select("obs_date", "cut", "tile_i", "tile_j", F.when(F.col("cut") < cuts, 1).otherwise(F.ceil(F.col("n") / most)).cast("int").alias("parts"))


def boxes_points_adaptive(boxes: DataFrame, points: DataFrame, most: int = TILE_POINTS, cuts: int = TILE_CUTS) -> DataFrame:
    """boxes_points by tiles that are the finer the more points they hold, so that a tile with most of the points is spread.

    Equal boxes meet the points as one: a box has a row for each of its finest tiles and their parts.
    """
    keep = [c for c in boxes.columns if c not in (*BOX, "query_id")]
    return for_equal_boxes(boxes, lambda q: _points_of_split_tiles(q.select("query_id", *BOX), points, most, cuts), *keep)


def _points_of_split_tiles(boxes: DataFrame, points: DataFrame, most: int, cuts: int) -> DataFrame:
    write = written(points.sparkSession)
    splits = write(split_tiles(points, most, cuts))
    known = F.broadcast(splits) if splits.count() <= BROADCAST_SPLITS else splits
    at = ["obs_date", "tile_i", "tile_j"]
    d = points.withColumns({"cut": F.lit(0), "part": F.lit(0), "tile_i": _tile_of("lon", -180.0, 0), "tile_j": _tile_of("lat", -90.0, 0)})
    b = exploded_tiles(exploded_days(boxes)).withColumns({"cut": F.lit(0), "part": F.lit(0)})
    row_hash = F.xxhash64(*points.columns)
    for c in range(cuts + 1):
        here = known.where(F.col("cut") == c).drop("cut")
        d, b = d.join(here, at, "left"), b.join(here, at, "left")
        cut_here = (F.col("cut") == c) & F.col("parts").isNotNull()
        if c == cuts:
            d = d.withColumn("part", F.when(cut_here, F.pmod(row_hash, F.col("parts")).cast("int")).otherwise(0)).drop("parts")
            b = b.withColumn("part", F.explode(F.when(cut_here, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.lit(0))))).drop("parts")
        else:
            finer = {"tile_i": _tile_of("lon", -180.0, c + 1), "tile_j": _tile_of("lat", -90.0, c + 1)}
            d = d.withColumns({n: F.when(cut_here, v).otherwise(F.col(n)) for n, v in finer.items()} | {"cut": F.when(cut_here, c + 1).otherwise(F.col("cut"))}).drop("parts")
            quarter = lambda n, k: F.when(cut_here, F.col(n) * 2 + k).otherwise(F.col(n)).alias(n)  # noqa: B023, E731
            quarters = F.array(*[F.struct(quarter("tile_i", x), quarter("tile_j", y)) for x in (0, 1) for y in (0, 1)])
            b = b.withColumn("q", F.explode(F.when(cut_here, quarters).otherwise(F.slice(quarters, 1, 1))))
            b = b.withColumns({"tile_i": F.col("q.tile_i"), "tile_j": F.col("q.tile_j"), "cut": F.when(cut_here, c + 1).otherwise(F.col("cut"))}).drop("q", "parts")
            size = F.lit(TILE) / F.pow(F.lit(2.0), F.col("cut"))
            reached = [(F.col(f"{axis}_max") >= low + F.col(t) * size) & (F.col(f"{axis}_min") < low + (F.col(t) + 1) * size) for axis, t, low in (("lon", "tile_i", -180.0), ("lat", "tile_j", -90.0))]
            b = b.where((F.col("cut") != c + 1) | reached[0] & reached[1])
    both = b.join(d, [*at, "cut", "part"])
    return both.where(F.col("lon").between(F.col("lon_min"), F.col("lon_max")) & F.col("lat").between(F.col("lat_min"), F.col("lat_max"))).drop("tile_i", "tile_j", "cut", "part")


def _meetings(left: DataFrame, right: DataFrame, many: bool = False) -> DataFrame:
    """Boxes a_ of one frame and b_ of another on all days and tiles that they have in common. many: the pairs are many more than the boxes."""
    own = ["query_id", "lon_min", "lon_max", "lat_min", "lat_max", "date_start"]
    sides = [exploded_tiles(exploded_days(d)).select("obs_date", "tile_i", "tile_j", *[F.col(c).alias(f"{x}_{c}") for c in own]) for d, x in ((left, "a"), (right, "b"))]
    at = ["obs_date", "tile_i", "tile_j"]
    return (spread(sides[0], *at) if many else sides[0]).join(spread(sides[1], *at) if many else sides[1], at)


def _pairs(boxes: DataFrame, above: float, many: bool = False) -> DataFrame:
    first = (F.col("obs_date") == F.greatest("a_date_start", "b_date_start")) & (F.col("tile_i") == F.floor((F.greatest("a_lon_min", "b_lon_min") + 180) / TILE)) & (F.col("tile_j") == F.floor((F.greatest("a_lat_min", "b_lat_min") + 90) / TILE))
    pairs = _meetings(boxes, boxes, many).where("a_query_id < b_query_id").where(first)  # a pair counts on its first common day and in its first common tile
    iou = box_iou("a_", "b_")
    return pairs.select(F.col("a_query_id").alias("a"), F.col("b_query_id").alias("b"), iou.alias("iou")).where(F.col("iou") > above)


def overlapping_boxes(boxes: DataFrame, above: float, digits: int | None = None) -> DataFrame:
    """Pairs (a < b) of boxes with intersection over union (to so many digits, if given) above a limit and a common date.

    Where boxes repeat, classes of equal ones are compared, and a pair of classes becomes all pairs of their members.
    """
    shown = F.col("iou") if digits is None else F.round("iou", digits).alias("iou")
    classes = equal_boxes(boxes)
    repeats, small = _repeats(classes)
    if not repeats:
        return _pairs(boxes, above, True).select("a", "b", shown)
    members = class_members(boxes, classes)
    members = F.broadcast(members) if small else members
    itself = classes.where((F.col("n_boxes") > 1) & (F.col("date_start") <= F.col("date_end"))).select(F.col("query_id").alias("a"), F.col("query_id").alias("b"), *[F.col(c).alias(f"{x}_{c}") for x in "ab" for c in BOX[:4]])
    itself = itself.select("a", "b", box_iou("a_", "b_").alias("iou")).where(F.col("iou") > above)
    both = _pairs(classes, above, True).unionByName(itself).select("a", "b", shown)
    for x in "ab":
        both = both.join(members.select(F.col("class_id").alias(x), F.col("members.query_id").alias(f"of_{x}")), x)
    x, y = F.col("x"), F.col("y")
    met = both.select("a", "b", "iou", F.explode("of_a").alias("x"), "of_b").select("a", "b", "iou", "x", F.explode("of_b").alias("y"))
    return met.where((F.col("a") != F.col("b")) | (x < y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), "iou")


def land_prefix_sums(mask: DataFrame) -> DataFrame:
    """Two-dimensional running sums of a mask, a row of the mask in each array: four look-ups give the land cells of any window."""
    rows = mask.withColumn("row_sum", F.sum(F.col("is_land").cast("long")).over(Window.partitionBy("i").orderBy("j")))
    sums = rows.withColumn("land", F.sum("row_sum").over(Window.partitionBy("j").orderBy("i")))
    return sums.groupBy("i").agg(F.transform(F.sort_array(F.collect_list(F.struct("j", "land"))), lambda x: x["land"]).alias("land"))


def index_window() -> dict[str, Column]:
    """Columns (w, e) and rows (s, n) of the mask that a box covers: first, and one past the last, within the mask."""
    def index(c: str, low: float, n: int, extra: int) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(n), F.floor((F.col(c) - low) / MASK_STEP).cast("int") + extra))

    return {"w": index("lon_min", -180.0, 1440, 0), "e": index("lon_max", -180.0, 1440, 1), "s": index("lat_min", -90.0, 720, 0), "n": index("lat_max", -90.0, 720, 1)}


def land_fraction(boxes: DataFrame, sums: DataFrame) -> DataFrame:
    """Share of land cells in each box's index window; 0 for an empty window. The mask's 720 rows of 1440 are broadcast."""
    d = boxes.withColumns({f"__{side}": index for side, index in index_window().items()})
    for side in ("n", "s"):
        d = d.join(F.broadcast(sums.select((F.col("i") + 1).alias(f"__{side}"), F.col("land").alias(f"__land_{side}"))), f"__{side}", "left")

    def below(side: str, column: str) -> Column:  # land cells south and west of a corner; none at the mask's edge
        return F.coalesce(F.when(F.col(column) > 0, F.get(f"__land_{side}", F.col(column) - 1)), F.lit(0))

    land = below("n", "__e") - below("n", "__w") - below("s", "__e") + below("s", "__w")
    size = (F.col("__e") - F.col("__w")) * (F.col("__n") - F.col("__s"))
    return d.withColumn("land_fraction", F.when(size > 0, land / size).otherwise(F.lit(0.0))).drop(*[c for c in d.columns if c.startswith("__")])


def draw(seed: int, what: str, id_: Column) -> Column:
    """Uniform in [0, 1) from the seed, a name and a row's number: the same on any partitioning."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.lit(what), id_)), 1, 13), 16, 10).cast("double") / float(2**52)


def candidate_boxes(ids: DataFrame, box, size: float, unit: str, first_day: str, n_days: int, window_days: int, seed: int) -> DataFrame:
    """Random boxes around uniform centres in a constraint, clamped to the globe, on days that leave room for the window."""
    if n_days < window_days:
        raise ValueError("the date range is shorter than the time window")
    lon = box.lon_min + draw(seed, "lon", F.col("query_id")) * (box.lon_max - box.lon_min)
    lat = box.lat_min + draw(seed, "lat", F.col("query_id")) * (box.lat_max - box.lat_min)
    d = ids.select("query_id", lon.alias("c_lon"), lat.alias("c_lat"), F.floor(draw(seed, "day", F.col("query_id")) * (n_days - window_days + 1)).cast("int").alias("day"))
    width, height = patch_degrees(F.lit(float(size)), unit, F.col("c_lat"))
    sides = clamp_to_globe(F.col("c_lon") - width / 2, F.col("c_lon") + width / 2, F.col("c_lat") - height / 2, F.col("c_lat") + height / 2)
    start = F.date_add(F.lit(first_day).cast("date"), F.col("day"))
    return d.select("query_id", *[s.alias(n) for s, n in zip(sides, ("lon_min", "lon_max", "lat_min", "lat_max"))], start.alias("date_start"), F.date_add(start, window_days - 1).alias("date_end"))


def greedy_accept(boxes: DataFrame, conflicts: DataFrame, checkpoint) -> DataFrame:
    """query_id of the boxes that a pass in order of query_id would keep: none conflicts with an earlier kept one.

    In every round a box is kept if no earlier box that it conflicts with is still open or kept; those later than a kept
    one go. conflicts: (a, b) with a < b. checkpoint: cuts the lineage of a frame, for instance by writing it.
    """
    state = checkpoint(boxes.select("query_id").distinct().withColumn("state", F.lit(0)))
    while True:
        later = conflicts.join(state.select(F.col("query_id").alias("a"), F.col("state").alias("sa")), "a").where("sa >= 0")
        worst = later.groupBy(F.col("b").alias("query_id")).agg(F.max(F.when(F.col("sa") == 1, 2).otherwise(1)).alias("block"))
        open_ = state.join(worst, "query_id", "left")
        new = F.when(F.col("state") != 0, F.col("state")).when(F.col("block") == 2, F.lit(-1)).when(F.col("block") == 1, F.lit(0)).otherwise(F.lit(1))
        state = checkpoint(open_.select("query_id", new.alias("state")))
        if not state.where("state = 0").limit(1).count():
            return state.where("state = 1").select("query_id")


#: Boxes that greedy_boxes decides on in its first round, and at most as many kept ones that it broadcasts.
HEAD = 10_000


def greedy_boxes(boxes: DataFrame, above: float, checkpoint, n: int | None = None, head: int = HEAD) -> DataFrame:
    """Boxes that a pass in order of query_id keeps: none overlaps an earlier kept one by more than `above`. With n, at least the first n of them.

    A round decides on the first open boxes by greedy_accept, then drops the others that overlap what it kept. So only
    pairs within a round and pairs with kept boxes, of which there is room for few, are ever made. Rounds get larger
    where they hold few conflicts.
    """
    rest, kept, so_far = checkpoint(boxes), [], 0
    while True:
        now = checkpoint(rest.orderBy("query_id").limit(head))
        size, last = now.agg(F.count(F.lit(1)), F.max("query_id")).first()
        if not size:
            break
        conflicts = checkpoint(_pairs(now, above).select("a", "b"))
        new = checkpoint(now.join(greedy_accept(now, conflicts, checkpoint), "query_id", "left_semi"))
        kept.append(new)
        added = new.count()
        so_far += added
        if size < head or n is not None and so_far >= n:
            break
        there = F.broadcast(new) if added <= HEAD else new
        hit = _meetings(rest.where(F.col("query_id") > last), there).where(box_iou("a_", "b_") > above).select(F.col("a_query_id").alias("query_id")).distinct()
        rest = checkpoint(rest.where(F.col("query_id") > last).join(hit, "query_id", "left_anti"))
        head = min(4 * head, 16 * HEAD) if conflicts.count() <= 4 * size else head
    out = kept[0] if kept else rest
    for more in kept[1:]:
        out = out.unionByName(more)
    return out


def starts(low: float, high: float, size: float, overlap: float) -> list[float]:
    """Left edges of patches of a size between two bounds, the last moved to fit the end."""
    step, out = size * (1 - overlap), []
    for k in range(max(0, ceil((high - size + 0.001 - low) / step))):
        out.append(low + k * step)
    if out and out[-1] + size < high - 0.001:
        out.append(high - size)
    return out


def evaluation_grid(spark: SparkSession, box, size: float, overlap: float, first_day: str, n_days: int, stride_days: int, window_days: int, height: float | None = None) -> DataFrame:
    """A regular grid of boxes over a constraint and dates, numbered by date, then longitude and latitude. height: if not that of a square."""
    height = size if height is None else height
    lons, lats = starts(box.lon_min, box.lon_max, size, overlap), starts(box.lat_min, box.lat_max, height, overlap)
    days = range(0, n_days - window_days + 1, stride_days)
    if not days:
        raise ValueError("the date range is shorter than the time window")
    n = len(lons) * len(lats)
    at = F.col("id") % n
    d = spark.range(len(days) * n).select(
        F.col("id").alias("query_id"), F.element_at(F.array(*map(F.lit, lons)), (F.floor(at / len(lats)) + 1).cast("int")).alias("lon_min"), F.element_at(F.array(*map(F.lit, lats)), (at % len(lats) + 1).cast("int")).alias("lat_min"),
        F.date_add(F.lit(first_day).cast("date"), (F.floor(F.col("id") / n) * stride_days).cast("int")).alias("date_start"),
    )
    return d.withColumns({"lon_max": F.col("lon_min") + size, "lat_max": F.col("lat_min") + height, "date_end": F.date_add("date_start", window_days - 1)})


def training_boxes(ids: DataFrame, box, size: float, unit: str, first_day: str, n_days: int, window_days: int, seed: int, sums: DataFrame, n: int, checkpoint, max_land: float = 0.3, max_overlap: float = 1.0) -> DataFrame:
    """The first n boxes in order of query_id that have little land and don't overlap an earlier one much: what a pass over all candidates keeps.

    ids: candidate numbers, more than n. sums: land_prefix_sums. Overlap is looked at only where max_overlap is below 1.
    """
    d = candidate_boxes(ids, box, size, unit, first_day, n_days, window_days, seed)
    d = checkpoint(land_fraction(d, sums).where(F.col("land_fraction") <= max_land))
    if max_overlap < 1:
        d = greedy_boxes(d, max_overlap, checkpoint, n)
    return d.orderBy("query_id").limit(n)


def evaluation_boxes(spark: SparkSession, box, size: float, unit: str, overlap: float, first_day: str, n_days: int, stride_days: int, window_days: int, sums: DataFrame, max_land: float = 0.5) -> DataFrame:
    """The evaluation grid with each box as wide as its own latitude asks, without boxes of much land, in order of date and place."""
    if unit == "deg":
        width = height = size
    else:  # strides by the middle latitude of the constraint
        height = size / KM_PER_DEGREE_BOX
        width = height / max(cos(radians((box.lat_min + box.lat_max) / 2)), 0.1)
    grid = evaluation_grid(spark, box, width, overlap, first_day, n_days, stride_days, window_days, height)
    own_width, own_height = patch_degrees(F.lit(float(size)), unit, F.col("lat_min") + height / 2)
    sized = grid.withColumns({"lon_max": F.col("lon_min") + own_width, "lat_max": F.col("lat_min") + own_height})
    return land_fraction(sized, sums).where(F.col("land_fraction") <= max_land).orderBy("date_start", "lon_min", "lat_min")


def bounding_boxes(tiles: DataFrame, footprint: str = "footprint", centroid: str = "centroid") -> DataFrame:
    """Tiles with a bounding box: that of the footprint (WKT), else the centroid as a box without area, else NULL."""
    text = F.coalesce(F.when(F.length(footprint) > 0, F.when(F.lower(footprint) != "none", F.col(footprint))), F.when(F.length(centroid) > 0, F.when(F.lower(centroid) != "none", F.col(centroid))))
    numbers = F.transform(F.regexp_extract_all(text, F.lit(r"(-?[0-9.]+(?:[eE][-+]?[0-9]+)?)"), F.lit(1)), lambda x: x.cast("double"))
    xs, ys = F.filter("__xy", lambda x, k: k % 2 == 0), F.filter("__xy", lambda x, k: k % 2 == 1)
    d = tiles.withColumn("__xy", numbers)
    return d.withColumns({"lon_min": F.array_min(xs), "lon_max": F.array_max(xs), "lat_min": F.array_min(ys), "lat_max": F.array_max(ys)}).drop("__xy")


def split_at_dateline(boxes: DataFrame) -> DataFrame:
    """A box with lon_min > lon_max becomes two."""
    one = F.array(F.struct(F.col("lon_min").alias("w"), F.col("lon_max").alias("e")))
    two = F.array(F.struct(F.col("lon_min").alias("w"), F.lit(180.0).alias("e")), F.struct(F.lit(-180.0).alias("w"), F.col("lon_max").alias("e")))
    d = boxes.withColumn("__part", F.explode(F.when(F.col("lon_min") > F.col("lon_max"), two).otherwise(one)))
    return d.withColumns({"lon_min": F.col("__part.w"), "lon_max": F.col("__part.e")}).drop("__part")


def touches(boxes: DataFrame, box) -> DataFrame:
    """Boxes that touch another one (inclusive), also when shifted by a full turn."""
    parts = [(box.lon_min, box.lon_max)] if box.lon_min <= box.lon_max else [(box.lon_min, 180.0), (-180.0, box.lon_max)]
    hit = F.lit(False)
    for w, e in parts:
        for turn in (-360.0, 0.0, 360.0):
            hit = hit | ((F.col("lon_min") + turn <= e) & (F.col("lon_max") + turn >= w))
    return boxes.where(hit & (F.col("lat_min") <= box.lat_max) & (F.col("lat_max") >= box.lat_min))


def regions_of_boxes(boxes: DataFrame, regions: DataFrame) -> DataFrame:
    """Regions that share area with a box (open overlap); the eight regions are broadcast."""
    meets = (F.col("lat_max") > F.col("r_lat_min")) & (F.col("lat_min") < F.col("r_lat_max")) & (F.col("lon_max") > F.col("r_lon_min")) & (F.col("lon_min") < F.col("r_lon_max"))
    return boxes.join(F.broadcast(regions), meets).select("query_id", "region_id", "region")


def resized(boxes: DataFrame, width: float, height: float, days: int) -> DataFrame:
    """The same centres with another size and window, clamped to the globe."""
    lon, lat = (F.col("lon_min") + F.col("lon_max")) / 2, (F.col("lat_min") + F.col("lat_max")) / 2
    sides = clamp_to_globe(lon - width / 2, lon + width / 2, lat - height / 2, lat + height / 2)
    return boxes.select("query_id", *[s.alias(n) for s, n in zip(sides, ("lon_min", "lon_max", "lat_min", "lat_max"))], "date_start", F.date_add("date_start", days - 1).alias("date_end"))


def box_summary(boxes: DataFrame, max_land: float) -> DataFrame:
    return boxes.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("date_start").alias("n_days"), F.avg(F.col("lon_max") - F.col("lon_min")).alias("mean_width"), F.avg(F.col("lat_max") - F.col("lat_min")).alias("mean_height"),
        F.avg("land_fraction").alias("mean_land"), F.avg((F.col("land_fraction") > max_land).cast("int")).alias("share_above"),
    )


def histogram(frame: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    at = F.floor((F.col(column) - low) / ((high - low) / bins)).cast("int")
    return frame.groupBy(F.least(F.lit(bins - 1), F.greatest(F.lit(0), at)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def mask_from_edges(edges: DataFrame, grid: DataFrame) -> DataFrame:
    """Cells (row, lat, col, lon) whose centre lies inside polygons: an odd number of edges crosses to their east.

    Edges are brought to the rows that they span; a row's crossings are counted by the last column that lies west of them,
    and running sums from the east give the crossings beyond each cell.
    """
    step = MASK_STEP
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    d = edges.where("y1 != y2").withColumn("row", F.explode(F.sequence(F.ceil((low + 90) / step - 0.5).cast("int"), F.ceil((high + 90) / step - 0.5).cast("int"))))
    lat = -90 + (F.col("row") + 0.5) * step
    d = d.withColumn("lat", lat).where((F.col("lat") >= low) & (F.col("lat") < high))
    x = F.col("x1") + (F.col("lat") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    col = F.least(F.lit(round(360 / step) - 1), F.ceil((x + 180) / step - 0.5) - 1).cast("int")
    crossings = d.select("row", col.alias("col")).where("col >= 0").groupBy("row", "col").agg(F.count(F.lit(1)).alias("n"))
    beyond = F.sum(F.coalesce("n", F.lit(0))).over(Window.partitionBy("row").orderBy(F.desc("col")))
    return grid.join(crossings, ["row", "col"], "left").withColumn("is_land", beyond % 2 == 1).drop("n")
