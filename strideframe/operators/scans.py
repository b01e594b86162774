"""Recurrences over ordered rows, dealt over tasks: scans of composed functions.

Rows are dealt by ranges of (key, order), so a long episode lies in many tasks, and packed as stretches of at most
``SIZE`` rows. Where a key has several stretches, each is summed up as the function that takes the state
before it to the state after it; the functions of a key, one small row a stretch, are applied one after the other to get
every stretch's own starting state; then all stretches run side by side.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SIZE = 4096


def stretches(df: DataFrame, key: str, order: str, value: str, size: int = SIZE) -> DataFrame:
    """key, at (the stretch's place in its key), orders, values. Rows without a value are left out."""
    types = df.select(key, order).schema
    kind, place = types[key].dataType.simpleString(), types[order].dataType.simpleString()

    def run(batches):
        held, orders, values, kinds = None, [], [], None

        def packed():
            return pa.RecordBatch.from_arrays([pa.array([held[0]], kinds[0]), pa.array([orders], pa.list_(kinds[1])), pa.array([values], pa.list_(pa.float64()))], names=["k", "orders", "values"])

        for batch in batches:
            kinds = [f.type for f in batch.schema]
            for k, o, v in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held is not None and (held[0] != k or len(orders) >= size):
                    yield packed()
                    held, orders, values = None, [], []
                held = (k,)
                orders.append(o)
                values.append(v)
        if held is not None:
            yield packed()

    rows = df.select(F.col(key).alias("k"), F.col(order).alias("o"), F.col(value).cast("double").alias("v")).where("v IS NOT NULL")
    dealt = rows.repartitionByRange("k", "o", "v").sortWithinPartitions("k", "o", "v")
    cut = dealt.mapInArrow(run, f"k {kind}, orders array<{place}>, values array<double>").checkpoint()
    numbered = cut.withColumn("first", F.get("orders", F.lit(0))).withColumn("low", F.get("values", F.lit(0)))
    order_of = W.partitionBy("k").orderBy("first", F.element_at("orders", -1), "low", F.element_at("values", -1))
    places = numbered.withColumns({"at": F.row_number().over(order_of), "of": F.count(F.lit(1)).over(W.partitionBy("k"))})
    return places.drop("first", "low").checkpoint()


def scanned(parts: DataFrame, summary: Callable, apply: Callable, each: Callable, out: str, order_kind: str, key: str, order: str, value: str) -> DataFrame:
    """Runs a recurrence over stretches(): summary(values, first) -> function as lists of doubles xs, ys; apply(xs, ys, state) -> state;
    each(values, state) -> (rows to keep, results). Returns key, order, value, ``out``."""
    kind = parts.schema["k"].dataType.simpleString()

    def sums(batches):
        for batch in batches:
            got = [summary(np.array(v), at == 1) for v, at in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([list(x) for x, _ in got], pa.list_(pa.float64())), pa.array([list(y) for _, y in got], pa.list_(pa.float64()))], names=["k", "at", "xs", "ys"])

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        state, before = float("nan"), []
        for xs, ys in zip(pdf["xs"], pdf["ys"], strict=True):
            before.append(state)
            state = apply(np.asarray(xs), np.asarray(ys), state)
        return pd.DataFrame({"k": pdf["k"], "at": pdf["at"], "state": before})

    def rows(batches):
        for batch in batches:
            cut = []
            for k, orders, values, state in zip(*[batch.column(i) for i in range(4)], strict=True):
                v = np.asarray(values.values)
                keep, result = each(v, state.as_py())
                n = len(keep)
                cut.append(pa.RecordBatch.from_arrays([pa.repeat(k, n), orders.values.take(pa.array(keep)), pa.array(v[keep]), pa.array(result)], names=["k", "o", "v", "r"]))
            yield from cut

    several = parts.where("of > 1").select("k", "at", "values").mapInArrow(sums, f"k {kind}, at int, xs array<double>, ys array<double>")
    states = several.groupBy("k").applyInPandas(chain, f"k {kind}, at int, state double")
    known = states.select(F.col("k").alias("_k"), F.col("at").alias("_at"), F.when(~F.isnan("state"), F.col("state")).alias("state"))
    started = parts.join(known, F.col("k").eqNullSafe(F.col("_k")) & (F.col("at") == F.col("_at")), "left").select("k", "orders", "values", "state")
    done = started.mapInArrow(rows, f"k {kind}, o {order_kind}, v double, r double")
    return done.select(F.col("k").alias(key), F.col("o").alias(order), F.col("v").alias(value), F.col("r").alias(out))


def limited(values: np.ndarray, most: float, state: float | None) -> np.ndarray:
    """The recurrence itself: out moves towards each value by ``most`` at most."""
    out, last = np.empty(len(values)), state
    for i, v in enumerate(values.tolist()):
        last = v if last is None else min(max(v, last - most), last + most)
        out[i] = last
    return out


def limit_function(values: np.ndarray, most: float, first: bool) -> tuple[np.ndarray, np.ndarray]:
    """The state after a stretch as a function of the one before, as knots of a line that is level or rises by 1.

    A value t sends a state x to x + most below t - most, to x - most above t + most, and to t between; so after
    every step what lay within ``most`` of t is one level piece. Beyond the outer knots the line rises by 1.
    """
    if first:
        return np.zeros(1), np.array([limited(values, most, None)[-1]])
    xs = ys = np.zeros(1)
    for t in values:
        for edge in (t - most, t + most):  # knots where the line meets the edges
            at = int(np.searchsorted(ys, edge))
            if at == len(ys):
                xs, ys = np.append(xs, xs[-1] + edge - ys[-1]), np.append(ys, edge)
            elif ys[at] != edge:
                xs, ys = np.insert(xs, at, xs[at] - (ys[at] - edge)), np.insert(ys, at, edge)
        ys = np.where(ys < t - most, ys + most, np.where(ys > t + most, ys - most, t))
        level = np.flatnonzero(ys == t)
        keep = np.ones(len(ys), bool)
        keep[level[1:-1]] = False
        xs, ys = xs[keep], ys[keep]
    return xs, ys


def apply_line(xs: np.ndarray, ys: np.ndarray, x: float) -> float:
    """Value of the line at x; a single knot with no state before it is the state itself."""
    if x != x:
        return float(ys[0])
    if x <= xs[0]:
        return float(ys[0] + x - xs[0])
    if x >= xs[-1]:
        return float(ys[-1] + x - xs[-1])
    at = int(np.searchsorted(xs, x))
    return float(ys[at] if ys[at] == ys[at - 1] else ys[at] - (xs[at] - x))


def slew_limited(df: DataFrame, key: str, order: str, value: str, most: float, size: int = SIZE) -> DataFrame:
    """Each value may differ from the previous output by ``most`` at most: key, order, value, ``limited``."""

    def each(v, state):
        return np.arange(len(v)), limited(v, most, state)

    return scanned(stretches(df, key, order, value, size), lambda v, first: limit_function(v, most, first), apply_line, each, "limited", df.schema[order].dataType.simpleString(), key, order, value)


def next_far(values: np.ndarray, at: int, level: float, gap: float) -> int:
    """The first place from ``at`` on whose value lies at least ``gap`` from level, else len(values)."""
    width = 16
    while at < len(values):
        far = np.abs(values[at : at + width] - level) >= gap
        if far.any():
            return at + int(far.argmax())
        at, width = at + width, 2 * width
    return len(values)


def kept_places(values: np.ndarray, gap: float, state: float | None) -> list[int]:
    at = 0 if state is None else next_far(values, 0, state, gap)
    out = []
    while at < len(values):
        out.append(at)
        at = next_far(values, at + 1, values[at], gap)
    return out


def waypoint_function(values: np.ndarray, gap: float, first: bool) -> tuple[np.ndarray, np.ndarray]:
    """The last kept value after a stretch as a function of the one before it.

    From a value x the first row kept is the first whose running maximum reaches x + gap or whose running minimum
    reaches x - gap, so only rows that raise the maximum or lower the minimum can be it. xs: their values;
    ys: the last kept value from there on. Places that follow the same chain are walked once.
    """
    last: dict[int, float] = {}

    def final(at: int) -> float:
        chain = []
        while at < len(values) and at not in last:
            chain.append(at)
            at = next_far(values, at + 1, values[at], gap)
        end = last[at] if at < len(values) else float(values[chain[-1]])
        last.update(dict.fromkeys(chain, end))
        return end

    if first:
        return np.array([values[0]]), np.array([final(0)])
    high, low = np.maximum.accumulate(values), np.minimum.accumulate(values)
    fresh = np.ones(len(values), bool)
    fresh[1:] = (high[1:] > high[:-1]) | (low[1:] < low[:-1])
    places = np.flatnonzero(fresh)
    return values[places], np.array([final(int(i)) for i in places])


def apply_waypoints(gap: float) -> Callable:
    def apply(xs: np.ndarray, ys: np.ndarray, x: float) -> float:
        if x != x:
            return float(ys[0])
        far = np.abs(xs - x) >= gap
        return float(ys[far.argmax()]) if far.any() else x

    return apply


def spaced_waypoints(df: DataFrame, key: str, order: str, value: str, gap: float, size: int = SIZE) -> DataFrame:
    """The rows whose value lies at least ``gap`` from that of the last kept one; the first row is kept: key, order, value."""

    def each(v, state):
        keep = np.array(kept_places(v, gap, state), dtype=np.int64)
        return keep, v[keep]

    out = scanned(stretches(df, key, order, value, size), lambda v, first: waypoint_function(v, gap, first), apply_waypoints(gap), each, "_r", df.schema[order].dataType.simpleString(), key, order, value)
    return out.drop("_r")
