"""Road graphs and plans: components by weight, covering walks, leg choice, timelines, parameter descent.

Walks and draws depend on their own past, so a (map, seed) is one task; road graphs have thousands of edges,
not millions. Everything else is relational.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strideframe.operators.relational import connected_components

STEPS = "map_id string, seed long, step int, u long, v long, edge long, kind string, weight double"


def largest_component(edges: DataFrame, key: str) -> DataFrame:
    """Edges of the component with the greatest total weight of each key; of equals that with the smallest node.

    edges: key, edge, u, v, weight.
    """
    node = lambda c: F.struct(F.col(key), F.col(c).alias("node"))
    parts = connected_components(edges.select(node("u").alias("u"), node("v").alias("v")))
    named = edges.join(parts.select(F.col(f"id.{key}").alias(key), F.col("id.node").alias("u"), F.col("component.node").alias("part")), [key, "u"])
    total = named.groupBy(key, "part").agg(F.sum("weight").alias("total"))
    best = total.groupBy(key).agg(F.max_by("part", F.struct("total", -F.col("part"))).alias("part"))
    return named.join(best, [key, "part"], "left_semi").select(*edges.columns)


def hop_distances(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """node, dist: least path weight from any source, by relaxing all frontier edges until nothing improves.

    edges: u, v, weight (walked both ways, not negative); sources: node. Unreachable nodes have no row.
    """
    both = edges.select("u", "v", "weight").union(edges.select("v", "u", "weight")).groupBy("u", "v").agg(F.min("weight").alias("w")).checkpoint()
    known = sources.select("node", F.lit(0.0).alias("dist")).distinct().checkpoint()
    front = known
    while front.limit(1).count():
        reach = front.join(both, front["node"] == both["u"]).groupBy(F.col("v").alias("node")).agg(F.min(F.col("dist") + F.col("w")).alias("new"))
        merged = known.join(reach, "node", "full").checkpoint()
        better = merged.where(F.col("new").isNotNull() & (F.col("dist").isNull() | (F.col("new") < F.col("dist"))))
        front = better.select("node", F.col("new").alias("dist"))
        known = merged.select("node", F.least("dist", "new").alias("dist"))
    return known


def _lightest(u: np.ndarray, v: np.ndarray, edge: np.ndarray, weight: np.ndarray) -> dict[int, list]:
    """(node, edge, weight) of the lightest road from each node to each of its neighbours; of equals the smallest edge."""
    rows = pd.DataFrame({"u": np.concatenate([u, v]), "v": np.concatenate([v, u]), "weight": np.concatenate([weight, weight]), "edge": np.concatenate([edge, edge])})
    rows = rows.sort_values(["u", "v", "weight", "edge"]).drop_duplicates(["u", "v"])
    near: dict[int, list] = {}
    for a, b, w, e in zip(*[rows[c].tolist() for c in ("u", "v", "weight", "edge")], strict=True):
        near.setdefault(a, []).append((b, e, w))
    return near


def _way(near: dict, start: int, left: dict) -> list:
    """Hops from start to the nearest node with fresh roads, of equally near ones the smallest; none if there is none.

    left counts the fresh roads at each node. The search ends with the first goals it settles.
    """
    dist, back, heap, goal = {start: 0.0}, {}, [(0.0, start)], None
    while heap:
        d, n = heapq.heappop(heap)
        if goal is not None and d > dist[goal]:
            break
        if d > dist[n]:
            continue
        if left[n] and (goal is None or n < goal):
            goal = n
        for m, edge, w in near[n]:
            if d + w < dist.get(m, float("inf")):
                dist[m], back[m] = d + w, (n, edge, w)
                heapq.heappush(heap, (d + w, m))
    path, n = [], goal
    while n is not None and n != start:
        path.append((n, *back[n][1:]))
        n = back[n][0]
    return path[::-1]


def _walk(pdf: pd.DataFrame) -> pd.DataFrame:
    """Covers every edge reachable from the smallest node: a random fresh road here, else the way to the nearest one.

    A node's roads are one stretch of an array in order of their edges, with a tree of counts over those that are fresh, so
    to draw a road takes the logarithm of how many the node has.
    """
    name, seed = pdf["map_id"].iloc[0], int(pdf["seed"].iloc[0])
    u, v, edge, weight = (pdf[c].to_numpy() for c in ("u", "v", "edge", "weight"))
    near, n = _lightest(u, v, edge, weight), len(pdf)
    row = np.arange(n)
    order = np.lexsort((np.concatenate([row, row]), np.concatenate([edge, edge]), np.concatenate([u, v])))  # darts u -> v, then v -> u
    place = np.empty(2 * n, np.int64)
    place[order] = np.arange(2 * n)
    _, road = np.unique(edge, return_inverse=True)
    darts_of = np.argsort(np.concatenate([road, road]), kind="stable")
    first_of = np.searchsorted(np.concatenate([road, road])[darts_of], np.arange(road.max(initial=-1) + 2)).tolist()
    nodes, starts = np.unique(np.concatenate([u, v])[order], return_index=True)
    ends = np.append(starts[1:], 2 * n)
    base, left = dict(zip(nodes.tolist(), starts.tolist(), strict=True)), dict(zip(nodes.tolist(), (ends - starts).tolist(), strict=True))
    size = dict(left)
    # a Fenwick tree a node: entry i (from 1) counts the fresh darts in (i - lowest bit of i, i]
    inside = np.arange(2 * n) - np.repeat(starts, ends - starts) + 1
    tree, place, darts_of = (inside & -inside).tolist(), place.tolist(), darts_of.tolist()
    tails, heads, road, order = np.concatenate([u, v]).tolist(), np.concatenate([v, u]).tolist(), road.tolist(), order.tolist()
    rng, fresh = np.random.default_rng(seed), np.ones(len(first_of) - 1, bool)
    at = int(nodes[0])
    tos, roads, covers, weights, froms = [], [], [], [], []

    def go(to, number, name_, w):
        froms.append(at), tos.append(to), roads.append(name_), weights.append(w), covers.append(bool(fresh[number]))
        if fresh[number]:
            fresh[number] = False
            for dart in darts_of[first_of[number] : first_of[number + 1]]:
                node = tails[dart]
                first, many, i = base[node] - 1, size[node], place[dart] - base[node] + 1
                left[node] -= 1
                while i <= many:
                    tree[first + i] -= 1
                    i += i & -i
        return to

    numbers = np.unique(edge)
    while True:
        if left[at]:
            want, first, many, i = int(rng.integers(left[at])), base[at] - 1, size[at], 0
            step = 1 << (many.bit_length() - 1)
            while step:  # the longest prefix with at most ``want`` fresh darts
                if i + step <= many and tree[first + i + step] <= want:
                    i += step
                    want -= tree[first + i]
                step >>= 1
            dart = order[base[at] + i]
            number = road[dart % n]
            at = go(heads[dart], number, edge[dart % n], weight[dart % n])
            continue
        path = _way(near, at, left)
        if not path:
            break
        for to, name_, w in path:
            at = go(to, int(np.searchsorted(numbers, name_)), name_, w)
    kind = np.where(covers, "cover", "reposition") if covers else np.array([], object)
    out = pd.DataFrame({"u": froms, "v": tos, "edge": roads, "kind": kind, "weight": weights})
    return out.assign(map_id=name, seed=seed, step=np.arange(len(out), dtype=np.int32))[["map_id", "seed", "step", "u", "v", "edge", "kind", "weight"]]


def covering_walks(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """STEPS of one walk per (map, seed) over all roads reachable from the map's smallest node.

    edges: map_id, edge, u, v, weight; seeds: map_id, seed.
    """
    rows = edges.select("map_id", "edge", "u", "v", "weight").join(seeds, "map_id")
    return rows.groupBy("map_id", "seed").applyInPandas(_walk, STEPS)


def seeded_draws(keys: DataFrame, key: str, seed: str, n: int, low: float, high: float) -> DataFrame:
    """key, i, value: n uniform draws of a numpy generator per key, the same whatever the partitioning."""

    def run(batches):
        for pdf in batches:
            rows = [(k, i, float(v)) for k, s in zip(pdf[key], pdf[seed], strict=True) for i, v in enumerate(np.random.default_rng(int(s)).uniform(low, high, n))]
            yield pd.DataFrame(rows, columns=[key, "i", "value"]).astype({"i": "int32"})

    kind = keys.schema[key].dataType.simpleString()
    return keys.select(key, seed).mapInPandas(run, f"{key} {kind}, i int, value double")


def best_legs(candidates: DataFrame, key: str, turn_lo: float, turn_hi: float) -> DataFrame:
    """Two legs per key: the bearing with most clearance, then that among those whose turn from it lies in [turn_lo, turn_hi].

    candidates: key, leg (1 or 2), bearing, clearance, walkable, banned. Ties go to the smaller bearing; no second leg gives nulls.
    """
    free = candidates.where(F.col("walkable") & ~F.coalesce("banned", F.lit(False)))
    best = F.struct("clearance", -F.col("bearing"))
    one = free.where("leg = 1").groupBy(key).agg(F.max_by(F.struct("bearing", "clearance"), best).alias("a"))
    two = free.where("leg = 2").select(key, "bearing", "clearance").join(one, key)
    turn = F.abs(F.pmod(F.col("bearing") - F.col("a.bearing") + 540, F.lit(360.0)) - 180)
    two = two.where(turn.between(turn_lo, turn_hi)).groupBy(key).agg(F.max_by(F.struct("bearing", "clearance"), best).alias("b"))
    return one.join(two, key, "left").select(key, F.col("a.bearing").alias("bearing1"), F.col("a.clearance").alias("clearance1"), F.col("b.bearing").alias("bearing2"), F.col("b.clearance").alias("clearance2"))


def longest_network(networks: DataFrame, key: str, least_m2: float) -> DataFrame:
    """The usable region with the longest centreline of each key: key, region, centreline_m; of equals the smaller region."""
    return networks.where((F.col("area_m2") >= least_m2) & F.col("error").isNull()).groupBy(key).agg(F.max_by("region", F.struct("centreline_m", -F.col("region"))).alias("region"), F.max("centreline_m").alias("centreline_m"))


def trapezoid(n: Column, ramp: Column) -> Column:
    """n weights of mean 1: half-cosine ramps of ``ramp`` frames at both ends, level between; level throughout if they do not fit."""
    rise = lambda i: 0.5 - 0.5 * F.cos(F.lit(np.pi) * i / F.greatest(ramp - 1, F.lit(1)))
    fits = (ramp > 0) & (n > 2 * ramp)
    raw = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(fits & (i < ramp), rise(i)).when(fits & (i >= n - ramp), rise(n - 1 - i)).otherwise(1.0))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    return F.transform(raw, lambda x: x * n / total(raw))


def constant_profile(total: Column, step: Column) -> Column:
    """Increments of ``step`` with one remainder at the end, summing to ``total`` exactly; the sign is that of total."""
    n = F.greatest(F.ceil(F.abs(total) / step - 1e-9), F.lit(1)).cast("int")
    signed = F.signum(total) * step
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.when(i < n, signed).otherwise(total - signed * (n - 1)))


def leg_timeline(legs: DataFrame, key: str) -> DataFrame:
    """One row per frame: key, frame, leg, x, y; each leg eases from its start to its end.

    legs: key, leg, frames, ramp, x0, y0, x1, y1. Weights are summed up over the frames of a leg, so a leg ends on its end point.
    """
    w = W.partitionBy(key).orderBy("leg")
    at = legs.withColumn("start", F.coalesce(F.sum("frames").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    rows = at.select("*", F.posexplode(trapezoid(F.col("frames"), F.col("ramp"))).alias("i", "weight"))
    inside = W.partitionBy(key, "leg").orderBy("i")
    t = F.sum("weight").over(inside.rowsBetween(W.unboundedPreceding, 0)) / F.col("frames")
    rows = rows.withColumn("t", t)
    on = lambda c: (F.col(f"{c}0") + (F.col(f"{c}1") - F.col(f"{c}0")) * F.col("t")).alias(c)
    return rows.select(key, (F.col("start") + F.col("i")).alias("frame"), "leg", on("x"), on("y"))


def coordinate_descent(df: DataFrame, options: dict[str, list[float]], start: dict[str, float], penalty: Callable[[dict[str, float]], Column]) -> tuple[dict[str, float], float, int]:
    """Best value of one knob after the other until a round changes nothing: (settings, penalty, rounds).

    penalty turns settings into an aggregate over df. All options of a knob are one aggregation, so df is read once a knob and round; only the loop over
    knobs is the driver's. Of equal penalties the present value stays, else the option listed first counts, so every change lowers the penalty and the descent ends.
    """
    now, least, rounds = dict(start), None, 0
    while True:
        rounds += 1
        before = dict(now)
        for knob, values in options.items():
            asked = [now[knob], *(v for v in values if v != now[knob])]
            got = df.agg(*[penalty({**now, knob: v}).alias(f"p{i}") for i, v in enumerate(asked)]).first()
            best = min(range(len(asked)), key=lambda i: (got[i] is None, got[i], i))
            now[knob], least = asked[best], got[best]
        if now == before:
            return now, least, rounds
