"""Status tables from several sources: manifests, results, claims, beacons, reviews, listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strideframe.session import ensure_checkpoints


def queue_status(manifest: DataFrame, results: DataFrame, claims: DataFrame, key: str, as_of: float, lease_s: int = 1800) -> DataFrame:
    """key, state, worker, age_s: a result's state, else that of a live claim, else stale or queued."""
    age = F.lit(as_of) - F.col("heartbeat_epoch")
    j = manifest.select(key).join(results.select(key, F.col("state").alias("_done")), key, "left").join(claims.select(key, "worker", "heartbeat_epoch", F.col("phase").alias("_phase")), key, "left")
    state = F.coalesce("_done", F.when(F.col("heartbeat_epoch").isNull(), "queued").when(age < lease_s, F.coalesce("_phase", F.lit("running"))).otherwise("stale"))
    return j.select(key, state.alias("state"), F.when(F.col("_done").isNull(), F.col("worker")).alias("worker"), F.when(F.col("_done").isNull(), age).alias("age_s"))


def overlay(base: DataFrame, over: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """base left join over; where both have a column the non-null value of ``over`` wins, then defaults fill nulls."""
    shared = [c for c in over.columns if c in base.columns and c != key]
    extra = [c for c in over.columns if c not in base.columns]
    o = over.select(key, *[F.col(c).alias(f"_{c}") for c in shared], *extra)
    value = lambda c: F.coalesce(F.col(f"_{c}"), F.col(c)) if c in shared else F.col(c)
    filled = lambda c: F.coalesce(value(c), F.lit(defaults[c])).alias(c) if c in defaults else value(c).alias(c)
    return base.join(o, key, "left").select(*[F.col(c) if c == key else filled(c) for c in (*base.columns, *extra)])


def upsert(table: DataFrame, news: DataFrame, key: str) -> DataFrame:
    """Full outer by key: a row of ``news`` replaces the table's; rows only in the table stay."""
    return table.join(news.select(key), key, "left_anti").unionByName(news)


def beacon_rows(beacons: DataFrame, key: str, text: str, wanted: str) -> DataFrame:
    """key, episode, frames, hours, accepted, error: rows of a JSON list or single object whose episode holds ``wanted``.

    A beacon without such a row gives one placeholder with an error text.
    """
    row = "struct<episode: string, contiguous_frames: bigint, hours: double, accepted: boolean, error: string>"
    listed = F.when(F.ltrim(text).startswith("["), F.from_json(text, f"array<{row}>")).otherwise(F.array(F.from_json(text, row)))
    kept = F.filter(listed, lambda r: F.coalesce(r["episode"].contains(wanted), F.lit(False)))
    rows = beacons.select(key, F.explode_outer(kept).alias("r"))
    return rows.select(key, "r.episode", F.col("r.contiguous_frames").alias("frames"), "r.hours", "r.accepted", F.when(F.col("r").isNull(), "no episode for this shard").otherwise(F.col("r.error")).alias("error"))


def project_levels(projects: DataFrame, rows: DataFrame, key: str, levels: str, separator: str = ";") -> DataFrame:
    """Projects with one row per listed level, joined with the level's row; levels without one keep nulls. Empty names drop out."""
    each = projects.withColumn("slug", F.explode(F.split(levels, separator))).withColumn("slug", F.trim("slug")).where("slug <> ''")
    return each.select(key, "slug").join(rows, "slug", "left")


def representative(projects: DataFrame, rows: DataFrame, key: str, size: str) -> DataFrame:
    """The level that stands for a project: recorded before not, then the largest, then the smaller slug; null if it has none."""
    j = projects.select(key, "slug").join(rows.select("slug", "recorded", size), "slug")
    best = j.groupBy(key).agg(F.min_by("slug", F.struct(F.when(F.col("recorded"), 0).otherwise(1), -F.coalesce(size, F.lit(0.0)), "slug")).alias("slug"))
    return projects.select(key).distinct().join(best, key, "left")


def enrich(manifest: DataFrame, other: DataFrame, key: str, packs: str, present: Column) -> DataFrame:
    """Columns of a second manifest by key; ``packs`` keeps those entries only for which present(entry) holds.

    A key that the second manifest lacks keeps nulls and an empty list.
    """
    extra = other.withColumn(packs, F.filter(packs, lambda p: present(p)))
    return manifest.join(extra, key, "left").withColumn(packs, F.coalesce(packs, F.array().cast("array<string>")))


def prioritised(sources: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """All candidates, the first source's before the second's: source columns, source, priority; of one key the first counts."""
    parts = [df.withColumns({"source": F.lit(name), "priority": F.lit(i)}) for i, (name, df) in enumerate(sources)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy("priority"))).where("_n = 1").drop("_n")


def deal(df: DataFrame, order: list[Column], n: int, out: str = "worker") -> DataFrame:
    """Rows dealt one by one in a global order, without a task that sees all of them.

    Rows are range-partitioned by the order and checkpointed with their part; a row's number is its place in the part
    plus the sizes of the parts before, of which there is one row each.
    """
    ensure_checkpoints(df.sparkSession)
    placed = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).checkpoint()
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("_part", "_before")
    numbered = placed.withColumn("_at", F.row_number().over(W.partitionBy("_part").orderBy(*order)))
    return numbered.join(F.broadcast(before), "_part").withColumn(out, (F.col("_before") + F.col("_at") - 1) % n).drop("_part", "_at", "_before")


def second_pass(plan: DataFrame, results: DataFrame, key: str, categories: list[str], workers: int) -> DataFrame:
    """Tasks of the given categories with what they took before (0: unknown), slowest first, dealt in turn: key, category, elapsed, worker.

    plan: key, category; results: key, elapsed (one row a key).
    """
    again = plan.where(F.col("category").isin(categories)).join(results.select(key, "elapsed"), key, "left").withColumn("elapsed", F.coalesce("elapsed", F.lit(0)))
    return deal(again, [F.desc("elapsed"), F.col(key)], workers)
