"""Aggregates: counts with fixed labels, roll-ups, chosen attempts, brightness and collision reports, grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def label_shares(df: DataFrame, key: str, label: str, labels: list[str]) -> DataFrame:
    """key, label, n, share for every label of a closed list, absent ones with 0; other labels count in the total only."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("_all"), *[F.count_if(F.col(label) == x).alias(f"_{i}") for i, x in enumerate(labels)])
    return n.select(key, "_all", F.inline(F.array(*[F.struct(F.lit(x).alias(label), F.col(f"_{i}").alias("n")) for i, x in enumerate(labels)]))).select(key, label, "n", (F.col("n") / F.col("_all")).alias("share"))


MAX_LABELS = 1000


def missing_labels(df: DataFrame, key: str, label: str, keeps: Column) -> DataFrame:
    """(key, label) pairs without a row that ``keeps``; keys and labels are those seen in df."""
    found = df.groupBy(key, label).agg(F.bool_or(F.coalesce(keeps, F.lit(False))).alias("kept"))
    vocabulary = [r[0] for r in df.select(label).where(F.col(label).isNotNull()).distinct().limit(MAX_LABELS + 1).collect()]
    if len(vocabulary) > MAX_LABELS:
        raise ValueError(f"{label} has more than {MAX_LABELS} labels, which is no closed list")
    want = df.select(key).distinct().select(key, F.explode(F.array(*[F.lit(x) for x in vocabulary]) if vocabulary else F.array().cast(f"array<{df.schema[label].dataType.simpleString()}>")).alias(label))
    return want.join(found.where("kept").select(key, label), [key, label], "left_anti")


def action_counts(actions: DataFrame, key: str, text: str, directions: dict[int, str], speeds: dict[int, str]) -> DataFrame:
    """key, kind (move, speed, cam, other), value, n from action names, in one pass.

    A walk gives a move by its angle and a speed; a camera turn gives the signs of its two rates beyond 0.1; anything
    else counts by the word before the first underscore. Angles and speeds without a name keep their number.
    """
    walk, turn = r"^move_strafe_(-?\d+)_(-?\d+)", r"^camera_rotate_incremental_dp(-?[\d.]+)_dy(-?[\d.]+)"
    a = F.col(text)
    part = lambda p, i: F.regexp_extract(a, p, i)
    named = lambda v, names, unit: F.coalesce(*[F.when(v == str(k), F.lit(x)) for k, x in names.items()], F.concat(v, F.lit(unit)))
    dp, dy = (F.expr(f"try_cast(regexp_extract({text}, '{turn}', {i}) AS double)".replace("\\", "\\\\")) for i in (1, 2))
    signs = F.concat_ws("+", F.when(dp < -0.1, "down").when(dp > 0.1, "up"), F.when(dy > 0.1, "right").when(dy < -0.1, "left"))
    pair = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    rows = F.when(a.rlike(walk), F.array(pair("move", named(part(walk, 2), directions, "deg")), pair("speed", named(part(walk, 1), speeds, "u/s"))))
    rows = rows.when(a.rlike(turn), F.array(pair("cam", F.coalesce(F.nullif(signs, F.lit("")), F.lit("still"))))).otherwise(F.array(pair("other", F.split_part(a, F.lit("_"), F.lit(1)))))
    return actions.select(key, F.inline(rows)).groupBy(key, "kind", "value").agg(F.count(F.lit(1)).alias("n"))


def pack_rollup(levels: DataFrame, pack: str, cls: str, order: list[str], hours: str) -> DataFrame:
    """pack, levels, n_best, hours of the best class, and the pack's class: the first in ``order`` that any level has."""
    rank = F.coalesce(*[F.when(F.col(cls) == x, F.lit(i)) for i, x in enumerate(order)], F.lit(len(order)))
    best = F.col(cls) == order[0]
    return levels.withColumn("_rank", rank).groupBy(pack).agg(F.count(F.lit(1)).alias("levels"), F.count_if(best).alias("n_best"), F.coalesce(F.sum(F.when(best, F.col(hours))), F.lit(0.0)).alias("hours"), F.min_by(cls, F.struct("_rank", cls)).alias("cls"))


def chosen_attempt(attempts: Column, chosen: Column) -> Column:
    """The attempt with the chosen number, else the last, else null; attempts: array of structs with ``attempt``."""
    last = F.when(F.size(attempts) > 0, F.element_at(attempts, -1))
    return F.coalesce(F.get(F.filter(attempts, lambda a: a["attempt"] == chosen), 0), last)


def first_or_last(rows: Column, good) -> Column:
    """The first struct for which good(struct) holds, else the last one."""
    return F.coalesce(F.get(F.filter(rows, good), 0), F.when(F.size(rows) > 0, F.element_at(rows, -1)))


def region_medians(samples: DataFrame, groups: list[str], metrics: list[str]) -> DataFrame:
    """groups, metric, median: each metric's median per group, one row a metric."""
    wide = samples.groupBy(*groups).agg(*[F.median(m).alias(m) for m in metrics])
    return wide.unpivot(groups, metrics, "metric", "median")


def exposure_score(target: float = 120.0, most_blown: float = 0.02, most_black: float = 0.02) -> Column:
    """Pixels lost at either end plus the distance of p50 from the target; null beyond a hard limit."""
    c = F.col
    return F.when((c("blown_frac") <= most_blown) & (c("black_frac") <= most_black), c("blown_frac") + c("black_frac") + F.abs(c("p50") - target) / 400.0)


def best_exposure(samples: DataFrame, key: str, ev: str, **limits: float) -> DataFrame:
    """Exposure of least median score among those that break no limit in any sample; of equals the smallest; null if all do."""
    s = samples.withColumn("_s", exposure_score(**limits))
    per = s.groupBy(key, ev).agg(F.percentile("_s", 0.5).alias("score"), F.bool_and(F.col("_s").isNotNull()).alias("ok"))
    return per.groupBy(key).agg(F.min_by(F.when(F.col("ok"), F.col(ev)), F.when(F.col("ok"), F.struct("score", ev))).alias("best"), F.min(F.when(F.col("ok"), F.col("score"))).alias("score"))


def brightness_rollup(samples: DataFrame, variant: str) -> DataFrame:
    """Mean, medians of the percentiles, worst ends and the p95 - p5 spread of the mean, per variant."""
    med = lambda c: F.median(c).alias(c)
    spread = F.percentile("mean_y", 0.95) - F.percentile("mean_y", 0.05)
    return samples.groupBy(variant).agg(F.avg("mean_y").alias("mean"), med("p10"), med("p50"), med("p99"), F.median("blown_frac").alias("blown"), F.max("blown_frac").alias("blown_max"), F.median("black_frac").alias("black"), F.max("black_frac").alias("black_max"), spread.alias("mean_spread"))


def collision_report(poses: DataFrame, key: str, fps: float, first: int = 12) -> DataFrame:
    """Hits, near-plane penetrations, least clearance, largest step and turn of a planned route.

    poses: key, frame, x, y, z, yaw, sweep_hit, near_hit (booleans), clearance_cm (null: nothing in range).
    """
    c = F.col
    w = W.partitionBy(key).orderBy("frame")
    nxt = lambda n: F.lead(n).over(w)
    step = F.sqrt(sum(((nxt(a) - c(a)) * (nxt(a) - c(a)) for a in "xyz"), F.lit(0.0)))
    turn = F.abs(F.pmod(nxt("yaw") - c("yaw") + 540, F.lit(360.0)) - 180)
    rows = poses.withColumns({"_step": step, "_turn": turn})
    listed = lambda flag: F.slice(F.array_sort(F.collect_list(F.when(c(flag), c("frame")))), 1, first)
    out = rows.groupBy(key).agg(F.count_if("sweep_hit").alias("collision_count"), F.count_if("near_hit").alias("penetration_count"), F.min("clearance_cm").alias("min_clearance_cm"), F.coalesce(F.max("_step"), F.lit(0.0)).alias("max_step_cm"), F.coalesce(F.max("_turn"), F.lit(0.0)).alias("max_turn_deg"), listed("sweep_hit").alias("first_hits"), listed("near_hit").alias("first_penetrations"))
    return out.withColumns({"max_yaw_rate": F.col("max_turn_deg") * fps, "collision_free": (F.col("collision_count") == 0) & (F.col("penetration_count") == 0)})


def five_numbers(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """n, min, p10, median, p90, max of a value per group."""
    q = lambda p, n: F.percentile(value, p).alias(n)
    return df.groupBy(*groups).agg(F.count(value).alias("n"), F.min(value).alias("low"), q(0.1, "p10"), q(0.5, "median"), q(0.9, "p90"), F.max(value).alias("high"))


def ranked_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """key, v, c, lo, hi, n: the distinct values of each key with their count and the ranks (from 0) they fill, of n rows.

    Value counts are dealt by ranges of (key, value), so a key with many values lies in many tasks; running sums within a range start from the sums of the
    ranges before it, one small row a range and key.
    """
    h = df.where(F.col(value).isNotNull()).groupBy(F.col(key).alias("k"), F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    h = h.repartitionByRange("k", "v").withColumn("part", F.spark_partition_id()).checkpoint()
    sums = h.groupBy("k", "part").agg(F.sum("c").alias("c"))
    whole = W.partitionBy("k")
    before = F.coalesce(F.sum("c").over(whole.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select(F.col("k").alias("_k"), F.col("part").alias("_part"), before.alias("start"), F.sum("c").over(whole).alias("n"))
    within = F.sum("c").over(W.partitionBy("k", "part").orderBy("v").rowsBetween(W.unboundedPreceding, 0))
    out = h.withColumn("within", within).join(starts, F.col("k").eqNullSafe(F.col("_k")) & (F.col("part") == F.col("_part")))
    hi = F.col("start") + F.col("within") - 1
    return out.select(F.col("k").alias(key), "v", "c", (hi - F.col("c") + 1).alias("lo"), hi.alias("hi"), "n")


def percentile_table(df: DataFrame, key: str, value: str, shares: dict[str, float]) -> DataFrame:
    """Exact linear percentiles per key from ranked value counts; only the two values at each rank's neighbours are looked at."""
    h = ranked_counts(df, key, value)
    out = []
    for name, q in shares.items():
        at = q * (F.col("n") - 1)
        below, above = F.floor(at), F.ceil(at)
        pick = lambda r: F.max(F.when((F.col("lo") <= r) & (r <= F.col("hi")), F.col("v")))
        share = F.max(at - below)
        out.append((pick(below) + share * (pick(above) - pick(below))).alias(name))
    return h.groupBy(key).agg(*out, F.max("v").alias("most"), (F.sum(F.col("v") * F.col("c")) / F.max("n")).alias("mean"))


def upper_median(df: DataFrame, key: str, value: str) -> DataFrame:
    """The element at floor(n / 2) of the sorted values, from ranked value counts."""
    return ranked_counts(df, key, value).where(F.col("hi") >= F.floor(F.col("n") / 2)).groupBy(key).agg(F.min("v").alias("upper_median"))


def physics_consistency(frames: DataFrame, key: str, opposing_least: float = 0.5) -> DataFrame:
    """Median progress along the heading of free and of blocked frames that were told to walk; the first frame of a contact counts in neither.

    frames: key, frame_id, cmd_move_forward, actual_yaw_deg, step_x_cm, step_y_cm, collision_hits (JSON text).
    """
    c = F.col
    yaw = F.radians("actual_yaw_deg")
    hits = F.from_json("collision_hits", "array<struct<impact_normal: array<double>>>")
    against = F.exists(hits, lambda h: (F.size(h["impact_normal"]) == 3) & (-(F.get(h["impact_normal"], 0) * F.cos(yaw) + F.get(h["impact_normal"], 1) * F.sin(yaw)) > opposing_least))
    walked = frames.where(F.coalesce("cmd_move_forward", F.lit(0.0)) > 0.5)
    rows = walked.select(key, "frame_id", F.coalesce(against, F.lit(False)).alias("opposing"), (F.coalesce("step_x_cm", F.lit(0.0)) * F.cos(yaw) + F.coalesce("step_y_cm", F.lit(0.0)) * F.sin(yaw)).alias("along"))
    entry = c("opposing") & ~F.coalesce(F.lag("opposing").over(W.partitionBy(key).orderBy("frame_id")), F.lit(False))
    rows = rows.withColumn("entry", entry).where("NOT entry")
    return rows.groupBy(key).agg(F.count_if(~c("opposing")).alias("n_free"), F.count_if("opposing").alias("n_blocked"), F.median(F.when(~c("opposing"), c("along"))).alias("free_median_cm"), F.median(F.when(c("opposing"), c("along"))).alias("blocked_median_cm"))


def depth_agreement(a: DataFrame, b: DataFrame, keys: list[str], z: str = "z") -> DataFrame:
    """Two decoded depth frames by pixel: share of equal and of equally valid pixels, largest and p99 difference of valid ones.

    keys: the frame's columns, then row and col. Depths of zero or less are not measurements.
    """
    frame = keys[:-2]
    both = a.select(*keys, F.col(z).alias("_a")).join(b.select(*keys, F.col(z).alias("_b")), keys)
    ok = (F.col("_a") > 0) & (F.col("_b") > 0)
    d = F.when(ok, F.abs(F.col("_a") - F.col("_b")))
    n = F.count(F.lit(1))
    return both.groupBy(*frame).agg((F.count_if(F.col("_a") == F.col("_b")) / n).alias("equal"), (F.count_if((F.col("_a") > 0) == (F.col("_b") > 0)) / n).alias("valid_equal"), F.max(d).alias("max_diff"), F.percentile(d, 0.99).alias("p99_diff"))


def parameter_grid(spark, **values: list) -> DataFrame:
    """One row per combination of the given value lists."""
    out = spark.range(1).select()
    for name, options in values.items():
        out = out.withColumn(name, F.explode(F.array(*map(F.lit, options))))
    return out


def integrity(df: DataFrame, key: str, order: str, number: str, value: str, declared: str) -> DataFrame:
    """key, finite, increasing, complete: values finite, numbers strictly increasing in file order, rows as many as declared."""
    w = W.partitionBy(key).orderBy(order)
    rows = df.withColumn("_up", F.coalesce(F.col(number) > F.lag(number).over(w), F.lit(True)))
    finite = F.coalesce(~F.isnan(value) & (F.abs(value) < float("inf")), F.lit(False))
    return rows.groupBy(key).agg(F.bool_and(finite).alias("finite"), F.bool_and("_up").alias("increasing"), (F.count(F.lit(1)) == F.max(declared)).alias("complete"))


def evenly_spaced(n: int, rows: Column, how: str) -> Column:
    """n positions (from 0) spread over ``rows``: 'round' half to even, 'truncate', 'capped' (truncate, of at most as many positions as rows), or 'inner' (without the ends)."""
    many = F.least(F.lit(n), rows).cast("int") if how == "capped" else F.lit(n)
    i = F.transform(F.sequence(F.lit(0), F.greatest(many, F.lit(1)) - 1), lambda x: x.cast("double"))
    step = (rows - 1) / F.greatest(many - 1, F.lit(1))
    if how == "round":
        return F.array_distinct(F.transform(i, lambda x: F.bround(x * step).cast("long")))
    if how == "inner":
        return F.array_distinct(F.transform(i, lambda x: F.floor((x + 1) * rows / (n + 1))))
    return F.array_distinct(F.transform(i, lambda x: F.floor(x * (rows - 1) / F.greatest(many - 1, F.lit(1)))))


def spread_rows(df: DataFrame, key: str, order: str, n: int, how: str | list[str]) -> DataFrame:
    """The rows of each key at evenly_spaced() positions, with ``at``: position by order. Several rules share one sort, and their rows tell ``how``."""
    # by number, as AQE would join these small rows to partitions whose sort is large
    dealt = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    placed = dealt.withColumns({"at": (F.row_number().over(W.partitionBy(key).orderBy(order)) - 1).cast("long"), "_n": F.count(F.lit(1)).over(W.partitionBy(key))})
    taken = lambda rule: F.array_contains(evenly_spaced(n, F.col("_n"), rule), F.col("at"))
    if isinstance(how, str):
        return placed.where(taken(how)).drop("_n")
    return placed.withColumn("how", F.explode(F.array_compact(F.array(*[F.when(taken(rule), F.lit(rule)) for rule in how])))).drop("_n")


def page_with_totals(df: DataFrame, order: list[Column], page: int, size: int, totals: dict[str, Column]) -> DataFrame:
    """One page of rows in order, each with totals of the whole set."""
    whole = df.agg(*[c.alias(n) for n, c in totals.items()])  # one row
    return df.orderBy(*order).offset(max(page, 0) * size).limit(size).crossJoin(F.broadcast(whole))
