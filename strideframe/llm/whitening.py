"""Whitening of embeddings by upper-triangle column aggregates.

Vectors become whole numbers (grid cells), equal ones count once. One aggregation with a generated SQL
expression per pair of dimensions, i <= j, sums the products of the centred entries; the driver gets these
d(d+1)/2 numbers only, assembles the covariance and decomposes it with LAPACK (numpy's eigh). Above ``BLOCK``
dimensions the same expressions run per pair of blocks of dimensions, so no plan holds more than BLOCK^2 of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SCALE, SHIFT, LIMIT = 64, 1_000_000, 1 << 52
BLOCK = 64
_EMPTY = "n long, deviation long, component int, whitened double, explained double, identity_error double"


def grid(vector: str) -> Column:
    """floor(64 * entry) + 1000000 of each entry; beyond 2^52 it stays there, as a double holds no finer steps."""
    return F.transform(vector, lambda c: F.floor(F.least(F.greatest(c.cast("double") * SCALE, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))) + F.lit(SHIFT))


def sound(vector: str) -> Column:
    """Not null, and every entry is there and finite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(False))


def means(df: DataFrame, vector: str, d: int) -> tuple[int, np.ndarray, list]:
    """Rows, means and sums of each dimension, in one aggregation; sums of whole numbers are exact."""
    kind = df.schema[vector].dataType.elementType.simpleString()
    entry = (lambda c: c) if kind == "double" else lambda c: c.cast("decimal(20,0)")
    row = df.agg(F.count("*").alias("n"), *[F.sum(entry(F.col(vector)[i])).alias(f"s{i}") for i in range(d)]).first()
    sums = [row[f"s{i}"] if kind == "double" else int(row[f"s{i}"]) for i in range(d)]
    return row["n"], np.array([s / row["n"] for s in sums], dtype=float), sums


def covariance(df: DataFrame, vector: str, n: int, centre: np.ndarray) -> np.ndarray:
    """The covariance with divisor n of an array column, centred before multiplying."""
    d = len(centre)
    out = np.zeros((d, d))

    def centred(lo: int, hi: int, name: str) -> list[Column]:
        return [(F.col(vector)[i].cast("double") - F.lit(float(centre[i]))).alias(f"{name}{i - lo}") for i in range(lo, hi)]

    if d <= BLOCK:
        names = [(i, j) for i in range(d) for j in range(i, d)]
        row = df.select(*centred(0, d, "a")).selectExpr(*[f"sum(a{i} * a{j}) AS p{i}_{j}" for i, j in names]).first()
        for i, j in names:
            out[i, j] = out[j, i] = row[f"p{i}_{j}"] / n
        return out
    # every vector goes to each pair of its blocks as two short arrays; the last block is filled with zeros
    blocks = [(lo, min(lo + BLOCK, d)) for lo in range(0, d, BLOCK)]
    parts = [F.array(*centred(lo, hi, "a"), *[F.lit(0.0)] * (BLOCK - hi + lo)).alias(f"b{k}") for k, (lo, hi) in enumerate(blocks)]
    pairs = [(k, m) for k in range(len(blocks)) for m in range(k, len(blocks))]
    sent = df.select(*parts).select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(m).alias("m"), F.col(f"b{k}").alias("a"), F.col(f"b{m}").alias("b")) for k, m in pairs])).alias("s"))
    sums = sent.select("s.k", "s.m", "s.a", "s.b").groupBy("k", "m").agg(*[F.expr(f"sum(a[{i}] * b[{j}]) AS p{i}_{j}") for i in range(BLOCK) for j in range(BLOCK)])
    for row in sums.collect():  # one row a pair of blocks: d * d numbers in all
        p = np.array(row[2:]).reshape(BLOCK, BLOCK)
        (a, b), (c, e) = blocks[row["k"]], blocks[row["m"]]
        out[a:b, c:e] = p[: b - a, : e - c] / n
        out[c:e, a:b] = out[a:b, c:e].T
    return out


def _projected(names: list[str], n: int, sums: list, centre: np.ndarray, matrix: np.ndarray, scale: np.ndarray):
    """Per batch: deviation (exact) and the projections, null where the component has no variance."""
    d = len(centre)
    pivot = np.array([s // n for s in sums], dtype=object)
    rest = [s - n * int(p) for s, p in zip(sums, pivot, strict=True)]  # in 0 .. n-1

    def deviation(x: np.ndarray) -> list:
        off = x - pivot.astype(np.int64)
        if len(off) and (int(np.abs(off).max()) + 1) ** 2 * n * n * d < 1 << 62:
            t = off * n - np.array(rest, dtype=np.int64)
            return (t * t).sum(1).tolist()
        exact = [sum((n * int(a) - r) ** 2 for a, r in zip(row, rest, strict=True)) for row in off]
        return [v if v < 1 << 63 else None for v in exact]

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("x"))
            x = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, d)
            w = (x - centre) @ matrix
            w = np.where(scale > 0, w / np.where(scale > 0, scale, 1), np.nan)
            whitened = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * w.shape[1]), pa.array(w.ravel(), from_pandas=True))
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(deviation(x), pa.int64()), whitened], names=[*names, "deviation", "w"])

    return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16) -> DataFrame:
    """One row per kept row and component: id_col, component, n, deviation, whitened, explained, identity_error.

    Rows with a null vector or null, NaN or infinite entries are dropped, and so are empty vectors and those
    that are not as long as most are (of equally frequent lengths the greatest counts). Repeated rows repeat; null ids stay; other
    columns are ignored; an empty table gives an empty result. Components without variance (eigenvalue up to
    d * 2^-52 of the largest) have a null ``whitened``; with no variance at all ``explained`` is null, and
    identity_error is over the components that have one, null if none has. A deviation over 2^63 - 1 is null.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(sound("v"))
    sizes = rows.where(F.size("v") > 0).groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], f"{_EMPTY}, id {kind}").select(F.col("id").alias(id_col), "component", "n", "deviation", "whitened", "explained", "identity_error")
    d = sizes[0]["d"]
    cells = rows.where(F.size("v") == d).select("id", grid("v").alias("x"))
    fit = common.save(cells.select("x").distinct(), "whitening-fit")
    n, centre, sums = means(fit, "x", d)
    variance = covariance(fit, "x", n, centre)
    trace = float(np.trace(variance))
    values, basis = np.linalg.eigh(variance)
    k = min(components, d)
    values, basis = values[::-1][:k].clip(min=0), basis[:, ::-1][:, :k]
    scale = np.where(values > d * 2.0**-52 * values[0], np.sqrt(values), 0.0)
    live = int((scale > 0).sum())
    error = None
    if live:
        white = fit.mapInArrow(_projected([], n, sums, centre, basis, scale), "deviation long, w array<double>")
        _, middle, _ = means(white, "w", live)
        error = float(np.abs(covariance(white, "w", n, middle) - np.eye(live)).max())
    common.forget(fit)
    explained = F.array(*[F.lit(float(v / trace) if trace > 0 else None).cast("double") for v in values])
    out = cells.mapInArrow(_projected(["id"], n, sums, centre, basis, scale), f"id {kind}, deviation long, w array<double>")
    out = out.select("id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return out.select(
        F.col("id").alias(id_col), (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        explained[F.col("at")].alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
