"""Road graphs from centre lines by tiles, and ways over them by joins."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.operators.tiles import TILED, dealt

_STEPS = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j]


def degrees(cells: DataFrame) -> DataFrame:
    """map_id, row, col, degree: how many of the eight neighbours are cells too (1 an end, 3 and more a junction)."""
    s = cells.select("map_id", "row", "col").distinct()
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in _STEPS])
    told = s.select("map_id", F.explode(around).alias("o"), "row", "col").select("map_id", (F.col("row") + F.col("o.i")).alias("row"), (F.col("col") + F.col("o.j")).alias("col"))
    near = told.groupBy("map_id", "row", "col").agg(F.count(F.lit(1)).cast("int").alias("n"))
    return s.join(near, ["map_id", "row", "col"], "left").select("map_id", "row", "col", F.coalesce("n", F.lit(0)).alias("degree"))


def _cell(row: str, col: str):
    return F.struct(F.col(row).alias("row"), F.col(col).alias("col"))


#: what a tile tells. kind 0: a way from node to node; 1: a stretch that enters the tile (er, ec: the cell before it) or leaves it (open);
#: 2: the tile itself with its first cell, open where it has nodes
_TOLD = "map_id string, kind int, open boolean, er int, ec int, dia int, rows array<int>, cols array<int>"
_HALO = 2  # a tile knows how many neighbours the neighbours of its cells have
_ROWS, _WINDOWS = 1 << 17, 1 << 21  # rows, and cells of windows, that numpy takes at once


def _traced(at: np.ndarray, row: np.ndarray, col: np.ndarray, r0: np.ndarray, c0: np.ndarray, forced: np.ndarray, tile: int) -> tuple[np.ndarray, ...]:
    """Of whole tiles: which cells are nodes; of each way or stretch whether it is whole, whether it is open, the cell before it (-1: it begins at a
    node), its diagonal steps and the place of its first cell among the cells of all, which come last.

    at: each cell's tile from 0; r0, c0: the corner of its window; forced: nodes whatever their neighbours.
    """
    wide, n = tile + 2 * _HALO, len(at)
    lr, lc = row - r0, col - c0
    inside = lambda rim: (lr >= rim) & (lr < wide - rim) & (lc >= rim) & (lc < wide - rim)
    own, known = inside(_HALO), np.flatnonzero(inside(1))
    spot = (at * wide + lr) * wide + lc
    number = np.full((int(at.max()) + 1) * wide * wide, -1, np.int32)
    number[spot] = np.arange(n)
    near = np.full((n, 8), -1, np.int32)
    for d, (i, j) in enumerate(_STEPS):
        near[known, d] = number[spot[known] + i * wide + j]
    there = near >= 0
    node = forced | (there.sum(1) != 2)
    turn = there @ np.arange(8)  # of a cell's two directions each tells the other
    a, d = np.nonzero(there & own[:, None])
    b = near[a, d]
    dart = np.full(n * 8, -1, np.int32)
    dart[a * 8 + d] = np.arange(len(a))
    through = ~node[b]
    on = through & own[b]
    last, steps = np.arange(len(a)), on.astype(np.int64)
    last[on] = dart[b[on] * 8 + turn[b[on]] - (7 - d[on])]  # direction 7 - d leads back
    going = np.flatnonzero(on & on[last])
    while going.size:
        ahead, before = last[going], going.size
        steps[going], last[going] = steps[going] + steps[ahead], last[ahead]
        going = going[on[last[going]]]
        if going.size == before:  # rings go round for ever
            break
    prior = np.where(node[a], -1, near[a, np.where(node[a], 0, turn[a] - d)])
    first = np.flatnonzero((prior < 0) | ~own[prior])
    end = last[first]
    whole = (prior[first] < 0) & ~through[end]
    # a way back begins with the reverse of the last dart
    place = row * (1 << 32) + col
    u, s, v, t = place[a[first]], place[b[first]], place[b[end]], place[a[end]]
    keep = ~whole | (u < v) | ((u == v) & (s <= t))
    first, end, whole = first[keep], end[keep], whole[keep]
    count = steps[first] + 2
    starts = np.cumsum(count) - count
    line = np.full(len(a), -1)
    line[end] = np.arange(len(end))
    held = np.flatnonzero(line[last] >= 0)
    of = line[last[held]]
    way = np.empty(int(count.sum()), np.int64)
    way[starts[of] + count[of] - 2 - steps[held]] = a[held]
    way[starts + count - 1] = b[end]
    diagonal = np.array([i * j != 0 for i, j in _STEPS])
    return node, whole, through[end], prior[first], np.bincount(of[diagonal[d[held]]], minlength=len(first)), starts, way


def _told(rows: pa.Table, tile: int) -> pa.RecordBatch:
    """_TOLD of whole tiles."""
    row, col, tr, tc = (rows[c].to_numpy().astype(np.int64) for c in ("row", "col", "tr", "tc"))
    at, own = rows["at"].to_numpy(), (row // tile == tr) & (col // tile == tc)
    node, whole, open_, prior, dia, starts, way = _traced(at, row, col, tr * tile - _HALO, tc * tile - _HALO, rows["node"].to_numpy(), tile)
    mine = np.flatnonzero(own)
    mine = mine[np.lexsort((col[mine], row[mine], at[mine]))]
    tiles, corner = np.unique(at[mine], return_index=True)
    corner, noded = mine[corner], np.isin(tiles, at[own & node])
    cells = np.concatenate([way, corner])
    offsets = np.concatenate([starts, len(way) + np.arange(len(corner) + 1)]).astype(np.int32)
    lists = lambda v: pa.ListArray.from_arrays(pa.array(offsets), pa.array(v[cells].astype(np.int32)))
    none, pad = np.ones(len(corner), bool), np.zeros(len(corner), np.int32)
    before = lambda v: pa.array(np.concatenate([v[prior], pad]).astype(np.int32), mask=np.concatenate([prior < 0, none]))
    kind, dia = np.concatenate([np.where(whole, 0, 1), pad + 2]).astype(np.int32), np.concatenate([dia, pad]).astype(np.int32)
    name = rows["map_id"].take(pa.array(cells[offsets[:-1]])).combine_chunks()
    return pa.RecordBatch.from_arrays([name, pa.array(kind), pa.array(np.concatenate([open_, noded])), before(row), before(col), pa.array(dia), lists(row), lists(col)], ["map_id", "kind", "open", "er", "ec", "dia", "rows", "cols"])


def _traced_tiles(cells: DataFrame, tile: int) -> DataFrame:
    """_TOLD of cells: map_id, row, col, node (one in any case). A task goes through its tiles in their order, some whole ones at once."""

    def several(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        row, col, tr, tc = (rows[c].to_numpy().astype(np.int64) for c in ("row", "col", "tr", "tc"))
        own, at = (row // tile == tr) & (col // tile == tc), rows["at"].to_numpy()
        live = np.flatnonzero(np.bincount(at, own)[at] > 0)  # tiles of halo cells alone tell nothing
        if not len(live):
            return
        at = np.unique(at[live], return_inverse=True)[1]
        rows = rows.take(pa.array(live)).drop_columns("at").append_column("at", pa.array(at))
        many = max(1, _WINDOWS // (tile + 2 * _HALO) ** 2)
        cuts = np.searchsorted(at, np.arange(0, at[-1] + 1, many))
        for lo, hi in zip(cuts, [*cuts[1:], len(at)], strict=True):
            part = rows.slice(lo, hi - lo)
            yield _told(part.drop_columns("at").append_column("at", pa.array(at[lo:hi] - at[lo])), tile)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                n += batch.num_rows
            if not n or (batch is not None and n < _ROWS):
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            name, tr, tc = rows["map_id"].combine_chunks().dictionary_encode().indices.to_numpy(), rows["tr"].to_numpy(), rows["tc"].to_numpy()
            at = np.concatenate([[0], np.cumsum((np.diff(name) != 0) | (np.diff(tr) != 0) | (np.diff(tc) != 0))])
            done = len(at) if batch is None else int(np.searchsorted(at, at[-1]))  # the last tile may go on
            yield from several(rows.slice(0, done).append_column("at", pa.array(at[:done])))
            held, n = rows.slice(done).to_batches(), len(at) - done

    near = dealt(cells.where("map_id IS NOT NULL"), _HALO, tile)
    return near.repartition(*TILED).sortWithinPartitions(*TILED).mapInArrow(run, _TOLD)


def _joined(parts: DataFrame) -> DataFrame:
    """map_id, dia, rows, cols of the ways made of stretches of several tiles. Pointer doubling gives each the last one of its way."""
    cell = lambda i: F.struct(F.element_at("rows", i).alias("row"), F.element_at("cols", i).alias("col"))
    prior = F.struct(F.col("er").alias("row"), F.col("ec").alias("col"))
    dart = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    parts = parts.select(
        "map_id", "dia", "rows", "cols", dart(cell(1), cell(2)).alias("dart"), (F.size("rows") - 1).cast("long").alias("steps"),
        F.when(F.col("er").isNotNull(), dart(prior, cell(1))).alias("entry"), F.when(F.col("open"), dart(cell(-2), cell(-1))).alias("next"),
    )
    now = parts.select("map_id", "dart", "entry", "next", "steps", F.when(F.col("next").isNull(), F.col("dart")).alias("end")).checkpoint()
    left = now.where("end IS NULL").count()
    while left:
        ahead = now.select("map_id", F.col("entry").alias("next"), F.col("next").alias("n2"), F.col("steps").alias("s2"), F.col("end").alias("e2"))
        hop = now.where("end IS NULL").drop("end").join(ahead, ["map_id", "next"])
        hop = hop.select("map_id", "dart", "entry", F.col("n2").alias("next"), (F.col("steps") + F.col("s2")).alias("steps"), F.col("e2").alias("end"))
        now = now.where("end IS NOT NULL").unionByName(hop).checkpoint()
        before, left = left, now.where("end IS NULL").count()
        if left == before:  # rings go round for ever
            break
    done = now.where("end IS NOT NULL").select("map_id", "dart", "end", F.col("steps").alias("rest"))
    line = done.join(parts, ["map_id", "dart"]).groupBy("map_id", "end").agg(
        F.sum("dia").cast("int").alias("dia"), F.max_by(F.col("entry").isNull(), "rest").alias("whole"),
        F.array_sort(F.collect_list(F.struct((-F.col("rest")).alias("o"), "rows", "cols"))).alias("way"),
    ).where("whole")
    # a stretch ends with the first cell of the next
    chain = lambda c: F.concat(F.flatten(F.transform("way", lambda x: F.slice(x[c], 1, F.size(x[c]) - 1))), F.array(F.element_at(F.element_at("way", -1)[c], -1))).alias(c)
    line = line.select("map_id", "dia", chain("rows"), chain("cols"))
    return line.where(F.struct(cell(1).alias("n"), cell(2).alias("s")) <= F.struct(cell(-1).alias("n"), cell(-2).alias("s")))


def road_edges(cells: DataFrame, tile: int = 64) -> DataFrame:
    """map_id, u, v (cells of nodes), length, cells (the way from u to v): chains of cells with two neighbours between nodes.

    A node is a cell whose number of neighbours is not two; in a map without any, its first cell row by row. Every
    step from a cell to a neighbour is a dart; the dart after it leads on through a cell with two neighbours. Tiles with a halo follow
    the darts of their own cells; only stretches that cross tiles are joined, by pointer doubling, so a way through n tiles takes log2(n) joins.
    Maps without nodes go through the tiles once more. Chains are found in
    both directions and kept in the one whose (first node, first step) is smaller. Closed rings without a node, in a map that has nodes, are
    no edges. Lengths are in cells: 1 or the square root of 2 a step.
    """
    cells = cells.select("map_id", F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col")).distinct()
    told = _traced_tiles(cells.withColumn("node", F.lit(False)), tile).checkpoint()
    first = F.min(F.struct(F.col("rows")[0].alias("row"), F.col("cols")[0].alias("col"))).alias("f")
    lone = told.where("kind = 2").groupBy("map_id").agg(F.bool_or("open").alias("noded"), first).where("NOT noded").select("map_id", "f").checkpoint()
    if lone.limit(1).count():
        marked = cells.join(lone, "map_id").select("map_id", "row", "col", (F.struct("row", "col") == F.col("f")).alias("node"))
        told = told.join(lone, "map_id", "left_anti").unionByName(_traced_tiles(marked, tile).checkpoint())
    ways, parts = told.where("kind = 0").select("map_id", "dia", "rows", "cols"), told.where("kind = 1")
    if parts.limit(1).count():
        ways = ways.unionByName(_joined(parts))
    way = F.transform(F.arrays_zip("rows", "cols"), lambda x: F.struct(x["rows"].alias("row"), x["cols"].alias("col")))
    length = F.size("rows") - 1 - F.col("dia") + F.col("dia") * 2.0**0.5
    return ways.select("map_id", "dia", "rows", way.alias("cells")).select("map_id", F.element_at("cells", 1).alias("u"), F.element_at("cells", -1).alias("v"), length.alias("length"), "cells")


def ways_to_nearest(edges: DataFrame, key: str, starts: DataFrame, goals: DataFrame) -> DataFrame:
    """key, start, step (from 1), u, v, edge, weight: the way from each start to the nearest goal of its key.

    edges: key, edge, u, v, weight > 0, walked both ways; starts: key, start; goals: key, node. Of equally far goals the
    smallest counts, of equally short ways the smallest edge at each node. Every node learns (distance, goal) by relaxing from all goals at
    once, so all starts share the search; then each node knows its edge towards its goal and ways are unrolled, a step a round. A start that is
    a goal, or reaches none, has no rows.
    """
    both = edges.select(key, "edge", "u", "v", "weight").unionByName(edges.select(key, "edge", F.col("v").alias("u"), F.col("u").alias("v"), "weight")).distinct().checkpoint()
    known = goals.select(key, "node").distinct().select(key, "node", F.struct(F.lit(0).cast(edges.schema["weight"].dataType).alias("dist"), F.col("node").alias("goal")).alias("far")).checkpoint()
    front = known
    while front.limit(1).count():
        reach = both.join(front.withColumnRenamed("node", "v"), [key, "v"])
        reach = reach.groupBy(key, F.col("u").alias("node")).agg(F.min(F.struct((F.col("far.dist") + F.col("weight")).alias("dist"), F.col("far.goal").alias("goal"))).alias("new"))
        merged = known.join(reach, [key, "node"], "full").withColumn("better", F.col("new").isNotNull() & (F.col("far").isNull() | (F.col("new") < F.col("far")))).checkpoint()
        front = merged.where("better").select(key, "node", F.col("new").alias("far"))
        known = merged.select(key, "node", F.when(F.col("better"), F.col("new")).otherwise(F.col("far")).alias("far"))
    there = known.select(key, F.col("node").alias("v"), F.col("far").alias("rest"))
    here = known.where("far.dist > 0").select(key, F.col("node").alias("u"))
    best = F.min(F.struct((F.col("rest.dist") + F.col("weight")).alias("dist"), F.col("rest.goal").alias("goal"), "edge", "v", "weight")).alias("b")
    to = both.join(there, [key, "v"]).join(here, [key, "u"]).groupBy(key, "u").agg(best).select(key, "u", "b.v", "b.edge", "b.weight").checkpoint()
    at = starts.select(key, "start").distinct().withColumn("u", F.col("start"))
    out, step = None, 0
    while True:
        step += 1
        hop = at.join(to, [key, "u"]).select(key, "start", F.lit(step).alias("step"), "u", "v", "edge", "weight").checkpoint()
        out = hop if out is None else out.unionByName(hop)
        if not hop.limit(1).count():
            return out
        at = hop.select(key, "start", F.col("v").alias("u"))
