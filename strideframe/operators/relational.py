"""Joins, rankings and reconciliations: latest wins, best row, proximity, leases, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def best_row(df: DataFrame, key: list[str], rank: list[Column], columns: list[str]) -> DataFrame:
    """The row of each key with the greatest rank struct; rank must end in a unique column."""
    picked = df.groupBy(*key).agg(F.max_by(F.struct(*columns), F.struct(*rank)).alias("_best"))
    return picked.select(*key, *[F.col(f"_best.{c}").alias(c) for c in columns])


def coalesce_sources(base: DataFrame, key: str, sources: list[tuple[str, DataFrame, str]], out: str) -> DataFrame:
    """Left joins in priority order; ``out`` is the first non-null value and ``out``_source its name."""
    name = F.lit(None).cast("string")
    value = None
    for label, df, column in sources:
        base = base.join(df.select(F.col(key), F.col(column).alias(f"_{label}")), key, "left")
    for label, _, _ in reversed(sources):
        c = F.col(f"_{label}")
        value = c if value is None else F.coalesce(c, value)
        name = F.when(c.isNotNull(), F.lit(label)).otherwise(name)
    return base.withColumns({out: value, f"{out}_source": name}).drop(*[f"_{label}" for label, _, _ in sources])


def proximity_join(left: DataFrame, right: DataFrame, key: str, x: str, y: str, radius: float) -> DataFrame:
    """Pairs of one key within ``radius``: grid cells of that size, the left side exploded to 3 x 3.

    Columns l and r are structs of the sides' rows; an equi-join on (key, cell), never a cross join.
    """
    cell = lambda c: F.floor(F.col(c) / radius)
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    a = left.select(F.col(key).alias("_k"), cell(x).alias("_cx"), cell(y).alias("_cy"), F.struct(*left.columns).alias("l"))
    a = a.withColumn("_dx", F.explode(around)).withColumn("_dy", F.explode(around)).select("_k", (F.col("_cx") + F.col("_dx")).alias("_cx"), (F.col("_cy") + F.col("_dy")).alias("_cy"), "l")
    b = right.select(F.col(key).alias("_k"), cell(x).alias("_cx"), cell(y).alias("_cy"), F.struct(*right.columns).alias("r"))
    d2 = F.pow(F.col(f"l.{x}") - F.col(f"r.{x}"), 2) + F.pow(F.col(f"l.{y}") - F.col(f"r.{y}"), 2)
    return a.join(b, ["_k", "_cx", "_cy"]).withColumn("dist", F.sqrt(d2)).where(F.col("dist") <= radius).select("l", "r", "dist")


def first_claim(events: DataFrame, slug: str, worker: str, at: list[str]) -> DataFrame:
    """First writer wins."""
    return events.groupBy(slug).agg(F.min_by(worker, F.struct(*at)).alias("owner"), F.min(at[0]).alias("claimed_at"))


def lease_state(claims: DataFrame, as_of: Column, lease_s: int = 1800) -> Column:
    age = as_of - F.col("heartbeat_epoch")
    return F.when(F.col("heartbeat_epoch").isNull(), "free").when(age < lease_s, "live").otherwise("expired")


def undirected(a: str, b: str) -> tuple[Column, Column]:
    return F.least(a, b).alias("u"), F.greatest(a, b).alias("v")


def connected_components(edges: DataFrame) -> DataFrame:
    """id, component by min labels with pointer jumping until no label changes; lineage is cut by checkpoint().

    Edges with a null end link nothing and are left out.
    """
    edges = edges.where(F.col("u").isNotNull() & F.col("v").isNotNull())
    both = edges.select(F.col("u"), F.col("v")).union(edges.select(F.col("v"), F.col("u"))).distinct().checkpoint()
    labels = both.groupBy(F.col("u").alias("id")).agg(F.least(F.min("v"), F.min("u")).alias("component")).checkpoint()
    while True:
        near = both.join(labels, both["v"] == labels["id"]).groupBy("u").agg(F.min("component").alias("near"))
        step = labels.join(near, labels["id"] == near["u"], "left").select("id", F.least("component", F.coalesce("near", "component")).alias("c"), F.col("component").alias("old"))
        jump = step.select(F.col("id").alias("j"), F.col("c").alias("to"))
        new = step.join(jump, F.col("c") == F.col("j"), "left").select("id", F.least("c", F.coalesce("to", "c")).alias("component"), "old").checkpoint()
        labels = new.select("id", "component")
        if not new.where("component <> old").limit(1).count():
            return labels
