"""Operators over ordered rows of an episode: lags, runs, prefixes, smoothing; recurrences are in scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def lag_metrics(df: DataFrame, key: str, order: list[str], value: str, clock: Column) -> DataFrame:
    """step, dt and rate from the previous row; 0 on the first."""
    w = W.partitionBy(key).orderBy(*order)
    step = F.coalesce(F.col(value) - F.lag(value).over(w), F.lit(0.0))
    dt = F.coalesce(clock - F.lag(clock).over(w), F.lit(0.0))
    return df.withColumns({"step": step, "dt": dt}).withColumn("rate", F.when(F.col("dt") > 0, F.col("step") / F.col("dt")).otherwise(0.0))


def adjacent_pairs(df: DataFrame, key: str, index: str, value: str) -> DataFrame:
    """Rows whose successor has index + 1, with the difference of value."""
    w = W.partitionBy(key).orderBy(index)
    return df.withColumns({"next_index": F.lead(index).over(w), "next_value": F.lead(value).over(w)}).where(F.col("next_index") == F.col(index) + 1).withColumn("delta", F.col("next_value") - F.col(value))


def islands(df: DataFrame, key: str, order: str, gap: float) -> DataFrame:
    """Gaps and islands with a tolerance: key, island, n, first, last."""
    w = W.partitionBy(key).orderBy(order)
    starts = F.when(F.col(order) - F.lag(order).over(w) > gap, 1).otherwise(0)
    marked = df.withColumn("_new", starts).withColumn("island", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return marked.groupBy(key, "island").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"), F.max(order).alias("last"))


def longest_run(df: DataFrame, key: str, index: str) -> DataFrame:
    """Longest run of consecutive indices per key; the earliest of equals. Repeated indices count once; one that is null is a run of one.

    One sort serves the window and the aggregate: the rows of a key come by index, each knows where its run began, and nothing is hashed.
    """
    many = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = W.partitionBy(key).orderBy(index)
    i, before = F.col(index), F.lag(index).over(w)
    # by number, as AQE would join these small rows to partitions whose sort is large
    begun = df.select(key, index).repartition(many, key).withColumn("_begin", F.when(before.isNull() | (before < i - 1), i))
    runs = begun.withColumn("_begin", F.max("_begin").over(w.rowsBetween(W.unboundedPreceding, 0)))
    length = F.when(i.isNull(), 1).otherwise(i - F.col("_begin") + 1).cast("long")
    begin = F.when(i.isNotNull(), F.col("_begin"))
    best = F.max(F.struct(length.alias("n"), (-begin).alias("o"), begin.alias("b")))
    return runs.groupBy(key).agg(best.alias("m")).select(key, F.col("m.n").alias("run_length"), F.col("m.b").alias("run_start"))


def contiguous_prefix(df: DataFrame, key: str, index: str) -> DataFrame:
    """How many indices follow from 0 without a gap."""
    w = W.partitionBy(key).orderBy(index)
    return df.select(key, index).distinct().withColumn("_rn", F.row_number().over(w) - 1).groupBy(key).agg(F.coalesce(F.min(F.when(F.col(index) != F.col("_rn"), F.col("_rn"))), F.count(F.lit(1))).alias("prefix"))


def arc_length(df: DataFrame, key: str, order: list[str], x: str, y: str) -> DataFrame:
    w = W.partitionBy(key).orderBy(*order)
    d = F.sqrt(F.pow(F.col(x) - F.lag(x).over(w), 2) + F.pow(F.col(y) - F.lag(y).over(w), 2))
    return df.withColumn("_d", F.coalesce(d, F.lit(0.0))).withColumn("arc", F.sum("_d").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_d")


def moving_average(df: DataFrame, key: str, order: list[str], value: str, half: int) -> DataFrame:
    """Centred mean over rows -half..half, shrinking at the ends."""
    return df.withColumn("smoothed", F.avg(value).over(W.partitionBy(key).orderBy(*order).rowsBetween(-half, half)))


def heading(df: DataFrame, key: str, order: list[str], x: str, y: str) -> DataFrame:
    """Central-difference heading in degrees; a standstill carries the last heading on."""
    w = W.partitionBy(key).orderBy(*order)
    dx = F.coalesce(F.lead(x).over(w), F.col(x)) - F.coalesce(F.lag(x).over(w), F.col(x))
    dy = F.coalesce(F.lead(y).over(w), F.col(y)) - F.coalesce(F.lag(y).over(w), F.col(y))
    raw = df.withColumn("_h", F.when((dx != 0) | (dy != 0), F.degrees(F.atan2(dy, dx))))
    return raw.withColumn("heading", F.coalesce(F.last("_h", True).over(w.rowsBetween(W.unboundedPreceding, 0)), F.lit(0.0))).drop("_h")


def smoothed_edges(df: DataFrame, key: str, order: list[str], value: str, half: int) -> DataFrame:
    """Centred mean over 2 * half + 1 rows with the first and last value standing in beyond the ends; the ends stay."""
    w = W.partitionBy(key).orderBy(*order)
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    width = 2 * half + 1
    rows = df.withColumns({"_i": F.row_number().over(w), "_n": F.count(F.lit(1)).over(whole), "_first": F.first(value).over(whole), "_last": F.last(value).over(whole), "_sum": F.sum(value).over(w.rowsBetween(-half, half))})
    before, after = F.greatest(F.lit(half + 1) - F.col("_i"), F.lit(0)), F.greatest(F.col("_i") + half - F.col("_n"), F.lit(0))
    mean = (F.col("_sum") + before * F.col("_first") + after * F.col("_last")) / width
    end = (F.col("_i") == 1) | (F.col("_i") == F.col("_n")) | (F.col("_n") < width)
    return rows.withColumn("smoothed", F.when(end, F.col(value)).otherwise(mean)).drop("_i", "_n", "_first", "_last", "_sum")


def curvature_cap(df: DataFrame, key: str, order: list[str], x: str, y: str, v_max: float, a_lat: float, floor: float) -> DataFrame:
    """``cap``: speed that keeps lateral acceleration on the circle through three neighbouring points, v_max at the ends and on straights."""
    w = W.partitionBy(key).orderBy(*order)
    at = lambda c, f: f(c).over(w)
    ax, ay, bx, by, cx, cy = at(x, F.lag), at(y, F.lag), F.col(x), F.col(y), at(x, F.lead), at(y, F.lead)
    sides = F.hypot(ax - bx, ay - by) * F.hypot(bx - cx, by - cy) * F.hypot(ax - cx, ay - cy)
    area = F.abs((bx - ax) * (cy - ay) - (cx - ax) * (by - ay)) / 2
    bend = F.when((area >= 1e-6) & (sides >= 1e-6), F.sqrt(a_lat * sides / (4 * F.nullif(area, F.lit(0.0)))))
    return df.withColumn("cap", F.greatest(F.least(F.lit(v_max), F.coalesce(bend, F.lit(v_max))), F.lit(floor)))


def reachable_speed(df: DataFrame, key: str, order: str, x: str, y: str, cap: str, a_long: float) -> DataFrame:
    """``speed``: the cap made reachable by acceleration a_long, forwards and then backwards along the path.

    With s the arc length, v(i)^2 = min over j of cap(j)^2 + 2 a |s(i) - s(j)|; before i that is a running minimum of
    cap^2 - 2 a s, after i one of cap^2 + 2 a s, so two windows replace both recurrences.
    """
    w = W.partitionBy(key).orderBy(order)
    d = F.coalesce(F.hypot(F.col(x) - F.lag(x).over(w), F.col(y) - F.lag(y).over(w)), F.lit(0.0))
    rows = df.withColumn("_d", d).withColumn("_s", F.sum("_d").over(w.rowsBetween(W.unboundedPreceding, 0)))
    q, two = F.col(cap) * F.col(cap), 2 * a_long
    rows = rows.withColumns({"_lo": q - two * F.col("_s"), "_hi": q + two * F.col("_s")})
    past = F.min("_lo").over(w.rowsBetween(W.unboundedPreceding, 0)) + two * F.col("_s")
    ahead = F.min("_hi").over(w.rowsBetween(0, W.unboundedFollowing)) - two * F.col("_s")
    return rows.withColumn("speed", F.sqrt(F.greatest(F.least(past, ahead), F.lit(0.0)))).drop("_d", "_s", "_lo", "_hi")


def entries(df: DataFrame, key: str, order: list[str], flag: str) -> DataFrame:
    """Rows whose flag is true while the previous row's is not."""
    w = W.partitionBy(key).orderBy(*order)
    return df.withColumn("_before", F.coalesce(F.lag(flag).over(w), F.lit(False))).where(F.col(flag) & ~F.col("_before")).drop("_before")


def jumps(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """``jump``: absolute change of a value from the previous row, null on the first."""
    w = W.partitionBy(key).orderBy(*order)
    return df.withColumn("jump", F.abs(F.col(value) - F.lag(value).over(w)))


def corners(df: DataFrame, key: str, order: list[str], x: str, y: str, least_deg: float) -> DataFrame:
    """First and last row and every row where the direction changes by at least least_deg."""
    w = W.partitionBy(key).orderBy(*order)
    into = F.degrees(F.atan2(F.col(y) - F.lag(y).over(w), F.col(x) - F.lag(x).over(w)))
    out = F.degrees(F.atan2(F.lead(y).over(w) - F.col(y), F.lead(x).over(w) - F.col(x)))
    turned = F.abs(F.pmod(out - into + 180, F.lit(360.0)) - 180)
    return df.withColumn("_turn", turned).where(F.col("_turn").isNull() | (F.col("_turn") >= least_deg)).drop("_turn")


def resample(df: DataFrame, key: str, x: str, y: str, arc: str, step: float) -> DataFrame:
    """Points every even share of the path of about ``step``: key, i, s, x, y, by linear interpolation between rows.

    df carries the arc length of each row; each row gives the samples up to its successor, so a path is never gathered.
    """
    w = W.partitionBy(key).orderBy(arc)
    whole = W.partitionBy(key)
    rows = df.select(key, F.col(arc).alias("s0"), F.col(x).alias("x0"), F.col(y).alias("y0"), F.lead(arc).over(w).alias("s1"), F.lead(x).over(w).alias("x1"), F.lead(y).over(w).alias("y1"), F.max(arc).over(whole).alias("total"))
    rows = rows.where("total > 0 AND s1 > s0").withColumn("n", F.greatest(F.lit(2), F.bround(F.col("total") / step).cast("int") + 1)).withColumn("gap", F.col("total") / (F.col("n") - 1))
    lo, hi = F.ceil(F.col("s0") / F.col("gap") - 1e-9), F.ceil(F.col("s1") / F.col("gap") - 1e-9) - 1
    last = F.when(F.col("s1") >= F.col("total"), F.col("n") - 1).otherwise(hi)
    rows = rows.withColumn("i", F.explode(F.when(last >= lo, F.sequence(lo, last)).otherwise(F.array().cast("array<bigint>"))))
    t = F.least(F.greatest((F.col("i") * F.col("gap") - F.col("s0")) / (F.col("s1") - F.col("s0")), F.lit(0.0)), F.lit(1.0))
    at = lambda c: F.col(f"{c}0") + (F.col(f"{c}1") - F.col(f"{c}0")) * t
    return rows.select(key, F.col("i").cast("int").alias("i"), (F.col("i") * F.col("gap")).alias("s"), at("x").alias("x"), at("y").alias("y"))
