"""Summaries of decoded pictures as Columns; kernels over maps are in tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def picture_stats(pictures: DataFrame, key: list[str], luma: str = "luma") -> DataFrame:
    """Decoded pictures (array of 0..255 values) -> mean, p10, p50, p99, blown (>= 250) and black (<= 5) shares.

    Percentiles read the histogram: the smallest value whose running count reaches the share.
    """
    v = pictures.select(*key, F.size(luma).alias("n"), F.explode(luma).alias("v"))
    h = v.groupBy(*key, "v").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n"))
    one = h.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("v", "c"))).alias("h"), F.max("n").alias("n"))  # 256 values at most
    total = lambda keep: F.aggregate(F.filter("h", keep), F.lit(0).cast("long"), lambda s, x: s + x["c"])
    reach = lambda q: F.get(F.filter(F.transform("h", lambda x: F.struct(x["v"].alias("v"), total(lambda y: y["v"] <= x["v"]).alias("cum"))), lambda x: x["cum"] >= q * F.col("n")), 0)["v"]
    mean = F.aggregate("h", F.lit(0.0), lambda s, x: s + x["v"] * x["c"]) / F.col("n")
    return one.select(*key, mean.alias("mean_y"), reach(0.1).alias("p10"), reach(0.5).alias("p50"), reach(0.99).alias("p99"), (total(lambda x: x["v"] >= 250) / F.col("n")).alias("blown_frac"), (total(lambda x: x["v"] <= 5) / F.col("n")).alias("black_frac"))


def look_stats(frames: DataFrame, luma: str, depth: str, dark: float = 8.0, buried_m: float = 0.6) -> DataFrame:
    """Adds dark share of luma, near share of valid depths, valid share, and whether most of what is valid is near."""
    valid = F.filter(depth, lambda z: z > 0)
    near = F.when(F.size(valid) > 0, F.size(F.filter(valid, lambda z: z < buried_m)) / F.size(valid)).otherwise(0.0)
    return frames.withColumns({"dark_frac": F.size(F.filter(luma, lambda y: y < dark)) / F.size(luma), "near_frac": near, "valid_frac": F.size(valid) / F.size(depth)}).withColumn("buried", F.col("near_frac") > 0.5)


def masked_metrics(pixels: DataFrame, keys: list[str], region: dict[str, tuple[int, int, int, int]], near: float, far: float, least: int) -> DataFrame:
    """keys, region, n, residual, sparkle, luma over the pixels in a box and a depth band; regions with under ``least`` pixels give nulls.

    pixels: keys, x, y, depth, diff, luma; region: name -> (x0, y0, x1, y1), upper ends exclusive.
    """
    c = F.col
    inside = F.array_compact(F.array(*[F.when((c("x") >= x0) & (c("x") < x1) & (c("y") >= y0) & (c("y") < y1), F.lit(name)) for name, (x0, y0, x1, y1) in region.items()]))
    rows = pixels.where(c("depth").between(near, far)).withColumn("region", F.explode(inside))
    n = F.count(F.lit(1))
    enough = lambda v: F.when(n >= least, v)
    return rows.groupBy(*keys, "region").agg(n.alias("n"), enough(F.avg("diff")).alias("residual"), enough(100 * F.count_if(c("diff") > 20) / n).alias("sparkle"), enough(F.avg("luma")).alias("luma"))
