"""Reports over ordered rows: stalls, trims, first passing candidates, offenders, requeues, pruned spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def stalls(df: DataFrame, key: str, order: list[str], counter: str, clock: str, least: float) -> DataFrame:
    """Runs of rows whose counter stays unchanged for at least ``least`` of the clock: key, counter, since, until, n."""
    w = W.partitionBy(key).orderBy(*order)
    changed = F.when(F.col(counter).eqNullSafe(F.lag(counter).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    runs = df.select(key, counter, clock, *[c for c in order if c != clock]).withColumn("_new", changed)
    runs = runs.withColumn("_run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return runs.groupBy(key, counter, "_run").agg(F.min(clock).alias("since"), F.max(clock).alias("until"), F.count(F.lit(1)).alias("n")).where(F.col("until") - F.col("since") >= least).drop("_run")


def trim_at_nth(df: DataFrame, key: str, order: list[str], done: Column, n: int) -> DataFrame:
    """Rows of each key up to and with the n-th completion; all rows where there are fewer."""
    before = W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn("_before", F.coalesce(F.sum(F.when(done, 1).otherwise(0)).over(before), F.lit(0))).where(F.col("_before") < n).drop("_before")


def first_passing(df: DataFrame, key: str, order: str, violation: str, most: float) -> DataFrame:
    """The first candidate whose violation is at most ``most``, else that with the least violation: key, chosen, passed."""
    good = F.col(violation) <= most
    out = df.groupBy(key).agg(F.min(F.when(good, F.col(order))).alias("_first"), F.min_by(order, F.struct(violation, order)).alias("_least"))
    return out.select(key, F.coalesce("_first", "_least").alias("chosen"), F.col("_first").isNotNull().alias("passed"))


def offenders(df: DataFrame, key: str, order: str, error: Column, tolerance: float, k: int = 12) -> DataFrame:
    """Worst error of each key and its first k rows over the tolerance, as comma-joined order values."""
    w = W.partitionBy(key).orderBy(order)
    rows = df.select(key, order, error.alias("_e")).withColumn("_over", F.col("_e") > tolerance)
    rows = rows.withColumn("_rank", F.sum(F.when(F.col("_over"), 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    shown = F.when(F.col("_over") & (F.col("_rank") <= k), F.col(order))
    return rows.groupBy(key).agg(F.max("_e").alias("worst"), F.count_if("_over").alias("n_over"), F.array_join(F.sort_array(F.collect_list(shown)), ",").alias("offenders"))


def band_distance(shares: DataFrame, key: str, label: str, share: str, low: float, high: float) -> DataFrame:
    """Sum of squared distances outside the band and the label farthest out: key, distance, worst."""
    d = F.greatest(F.lit(low) - F.col(share), F.col(share) - F.lit(high), F.lit(0.0))
    return shares.withColumn("_d", d).groupBy(key).agg(F.round(F.sum(F.col("_d") * F.col("_d")), 9).alias("distance"), F.max_by(label, F.struct(F.round("_d", 9), label)).alias("worst"))


def requeue(failures: DataFrame, key: str, seed: str, most: int = 2) -> DataFrame:
    """Retry with a new seed, at most ``most`` times: key, handled, action, next_seed (past the last, in steps of 100)."""
    out = failures.groupBy(key).agg(F.count(F.lit(1)).alias("handled"), F.max(seed).alias("_last"))
    return out.select(key, "handled", F.when(F.col("handled") < most, "requeue").otherwise("give_up").alias("action"), (F.floor((F.col("_last") + 100) / 100) * 100).cast("long").alias("next_seed"))


def unseen(listing: DataFrame, cache: DataFrame, identity: list[str]) -> DataFrame:
    """Rows of a listing whose identity (path, size, time) is not in the cache."""
    return listing.join(cache.select(*identity).distinct(), identity, "left_anti")


def spans_without_hits(spans: DataFrame, hits: DataFrame, key: str, start: str, end: str, at: str) -> DataFrame:
    """Spans of a key that hold none of its hits (both ends inclusive).

    Hits and span starts are merged in one order per key and the next hit at or after each start is
    carried back, so a key with many spans and hits never becomes all its pairs.
    """
    marks = hits.select(F.col(key), F.col(at).alias("_at"), F.lit(1).alias("_hit"), F.lit(None).cast(spans.schema[end].dataType).alias("_end"), F.lit(None).cast(spans.schema).alias("_row"))
    opens = spans.select(F.col(key), F.col(start).alias("_at"), F.lit(0).alias("_hit"), F.col(end).alias("_end"), F.struct(*spans.columns).alias("_row"))
    after = W.partitionBy(key).orderBy("_at", "_hit").rowsBetween(0, W.unboundedFollowing)
    merged = opens.unionByName(marks).withColumn("_next", F.first(F.when(F.col("_hit") == 1, F.col("_at")), True).over(after))
    return merged.where("_hit = 0 AND (_next IS NULL OR _next > _end)").select("_row.*")


def near_share(df: DataFrame, pixels: str, near: float) -> DataFrame:
    """Share of an array's values that lie within ``near``, and whether over a fifth does."""
    share = F.size(F.filter(pixels, lambda x: F.abs(x.cast("double")) < near)) / F.size(pixels)
    return df.withColumn("near_share", share).withColumn("buried", F.col("near_share") > 0.2)
