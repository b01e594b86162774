"""Registered queries over points, meshes, grids and road graphs: line items and parts stand in for their rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from strideframe.operators import evidence, graph, rasters, roads, rollups, sequence, spatial, tiles
from strideframe.plans.queries import query
from strideframe.session import ensure_checkpoints, table

#: the small hash that spreads a number over 0..m-1 in both engines
_H = "(({0} * 7919 + {1}) % {2})"


def _h(c: str, add: int, m: int):
    return (F.col(c) * 7919 + add) % m


_TRI = f"""t AS (SELECT p_partkey AS triangle, p_partkey % 5 AS k, {_H.format('p_partkey', 11, 1000)}::DOUBLE AS ax, {_H.format('p_partkey', 37, 997)}::DOUBLE AS ay, p_size * 2 AS s FROM part),
q AS (SELECT o_orderkey AS point, o_orderkey % 7 AS k, {_H.format('o_orderkey', 5, 1009)}::DOUBLE AS x, {_H.format('o_orderkey', 77, 1013)}::DOUBLE AS y FROM orders)"""


def _triangles(spark, d):
    c = F.col
    t = table(spark, d, "part").select(c("p_partkey").alias("triangle"), (c("p_partkey") % 5).alias("k"), _h("p_partkey", 11, 1000).cast("double").alias("ax"), _h("p_partkey", 37, 997).cast("double").alias("ay"), (c("p_size") * 2).alias("s"))
    return t.select("triangle", "k", "ax", "ay", (c("ax") + c("s")).alias("bx"), c("ay").alias("by"), c("ax").alias("cx"), (c("ay") + c("s")).alias("cy"))


def _points(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("point"), (F.col("o_orderkey") % 7).alias("k"), _h("o_orderkey", 5, 1009).cast("double").alias("x"), _h("o_orderkey", 77, 1013).cast("double").alias("y"))


@query(f"WITH {_TRI} SELECT q.point, min(t.triangle) AS triangle FROM q LEFT JOIN t ON t.k = q.k AND q.x >= t.ax AND q.y >= t.ay AND (q.x - t.ax) + (q.y - t.ay) <= t.s GROUP BY 1")
def first_triangle(spark, d):
    return spatial.first_triangle(_points(spark, d), _triangles(spark, d), "k", 40.0).select("point", "triangle")


@query(f"WITH {_TRI} SELECT q.point, arg_min(t.triangle, (sqrt(pow(q.x - t.ax, 2) + pow(q.y - t.ay, 2)), t.triangle)) AS near, round(min(sqrt(pow(q.x - t.ax, 2) + pow(q.y - t.ay, 2))), 6) AS dist FROM q LEFT JOIN t ON t.k = q.k GROUP BY 1")
def nearest_boundary(spark, d):
    ensure_checkpoints(spark)
    right = _triangles(spark, d).select("k", F.col("triangle").alias("target"), F.col("ax").alias("x"), F.col("ay").alias("y"))
    return spatial.nearest(_points(spark, d), right, "k").select("point", "near", F.round("dist", 6).alias("dist"))


@query(f"WITH {_TRI}, n AS (SELECT q.point, q.k, q.point % 20 AS road, min(sqrt(pow(q.x - t.ax, 2) + pow(q.y - t.ay, 2))) AS dist FROM q LEFT JOIN t ON t.k = q.k GROUP BY 1, 2, 3) SELECT k, road, round(max(dist), 6) AS worst, bool_and(coalesce(dist <= 160, false)) AS walked FROM n GROUP BY 1, 2")
def roads_walked(spark, d):
    ensure_checkpoints(spark)
    right = _triangles(spark, d).select("k", F.col("triangle").alias("target"), F.col("ax").alias("x"), F.col("ay").alias("y"))
    left = _points(spark, d).withColumn("road", F.col("point") % 20)
    return spatial.farthest_of_nearest(left, right, "k", "road").withColumn("worst", F.round("worst", 6))


_SIGHT = "v AS (SELECT vec_id, vec_id % 10 AS pair, list_transform(embedding, lambda e: e::DOUBLE) AS a, list_transform(embedding, lambda e, i: e::DOUBLE + 0.02 * ((vec_id * 7 + i) % 5 - 2)) AS b FROM embeddings)"


@query(f"""WITH {_SIGHT}, m AS (SELECT l.pair, l.vec_id AS l, r.vec_id AS r, list_sum(list_transform(list_zip(l.a, r.b), lambda x: ((x[1] > -0.1) <> (x[2] > -0.1))::INT + ((x[1] > 0) <> (x[2] > 0))::INT + ((x[1] > 0.1) <> (x[2] > 0.1))::INT + ((x[1] > 0.2) <> (x[2] > 0.2))::INT))::INT AS bits FROM v l JOIN v r USING (pair)),
k AS (SELECT *, row_number() OVER (PARTITION BY pair, l ORDER BY bits, r) AS a, row_number() OVER (PARTITION BY pair, r ORDER BY bits, l) AS b FROM m WHERE bits < 40) SELECT pair, l, r, bits FROM k WHERE a = 1 AND b = 1""")
def mutual_nearest(spark, d):
    """Descriptors of 256 bits, four thresholds of each vector's entries, against those of slightly changed vectors."""
    e = table(spark, d, "embeddings")
    word = lambda v, t: F.aggregate(F.transform(v, lambda x, i: F.when(x > t, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda s, x: s.bitwiseOR(x))
    code = lambda v: F.array(*[word(v, t) for t in (-0.1, 0.0, 0.1, 0.2)])
    same = F.transform("embedding", lambda x: x.cast("double"))
    moved = F.transform("embedding", lambda x, i: x.cast("double") + 0.02 * ((F.col("vec_id") * 7 + i + 1) % 5 - 2))
    side = lambda v: e.select((F.col("vec_id") % 10).alias("pair"), F.col("vec_id").alias("i"), code(v).alias("code"))
    return spatial.mutual_nearest(side(same), side(moved), "pair")


@query(f"""WITH {_TRI}, c AS (SELECT k, round_even(ax / 25, 0)::BIGINT AS cx, round_even(ay / 25, 0)::BIGINT AS cy, min(ax) AS z FROM t GROUP BY 1, 2, 3), p AS (SELECT *, round_even(x / 25, 0)::BIGINT AS gx, round_even(y / 25, 0)::BIGINT AS gy FROM q),
o AS (SELECT unnest([0, 1, 2, 3, 4, 5, 6, 7, 8, 9]) AS rank, unnest([0, -1, -1, -1, 0, 0, 0, 1, 1, 1]) AS i, unnest([0, -1, 0, 1, -1, 0, 1, -1, 0, 1]) AS j),
h AS (SELECT p.point, arg_min(c.z, o.rank) AS z, min(o.rank) AS rank FROM p, o, c WHERE c.k = p.k AND c.cx = p.gx + o.i AND c.cy = p.gy + o.j GROUP BY 1),
i AS (SELECT q.point, arg_min(t.ax + (q.x - t.ax) / t.s * (t.ay - t.ax) + (q.y - t.ay) / t.s * (t.s - t.ax), t.triangle) AS z FROM q JOIN t ON t.k = q.k AND q.x >= t.ax AND q.y >= t.ay AND (q.x - t.ax) + (q.y - t.ay) <= t.s GROUP BY 1)
SELECT q.point, round(CASE WHEN rank IS NULL THEN i.z ELSE h.z END, 6) AS z, CASE WHEN rank = 0 THEN 'cell' WHEN rank IS NOT NULL THEN 'neighbour' WHEN i.z IS NOT NULL THEN 'mesh' END AS z_from FROM q LEFT JOIN h USING (point) LEFT JOIN i USING (point)""")
def height_lookup(spark, d):
    cell = lambda c: F.bround(F.col(c) / 25).cast("long")
    cells = _triangles(spark, d).groupBy("k", cell("ax").alias("cx"), cell("ay").alias("cy")).agg(F.min("ax").alias("z"))
    mesh = _triangles(spark, d).withColumns({"az": F.col("ax"), "bz": F.col("ay"), "cz": F.col("cy") - F.col("ay")})
    return spatial.height_lookup(_points(spark, d), cells, "k", 25.0, mesh).select("point", F.round("z", 6).alias("z"), "z_from")


@query(f"WITH {_TRI} SELECT k, round_even(x / 50, 0)::BIGINT AS cx, round_even(y / 50, 0)::BIGINT AS cy, min(point) AS point, arg_min(floor((x + y) / 150)::BIGINT, point) AS band FROM q GROUP BY 1, 2, 3")
def one_per_cell(spark, d):
    p = _points(spark, d).withColumn("z", F.col("x") + F.col("y"))
    return spatial.one_per_cell(p, "k", "point", 50.0, 150.0).select("k", "cx", "cy", "point", "band")


@query(f"""WITH RECURSIVE {_TRI}, o AS (SELECT k, point, x, y, row_number() OVER (PARTITION BY k ORDER BY point) AS i FROM q),
r AS (SELECT k, 0::BIGINT AS i, []::STRUCT(x DOUBLE, y DOUBLE, p BIGINT)[] AS kept FROM (SELECT DISTINCT k FROM o) UNION ALL SELECT r.k, o.i, CASE WHEN len(list_filter(r.kept, lambda v: pow(v.x - o.x, 2) + pow(v.y - o.y, 2) <= 14400)) = 0 THEN list_append(r.kept, {{'x': o.x, 'y': o.y, 'p': o.point}}) ELSE r.kept END FROM r JOIN o ON o.k = r.k AND o.i = r.i + 1),
f AS (SELECT k, kept FROM r QUALIFY row_number() OVER (PARTITION BY k ORDER BY i DESC) = 1) SELECT k, unnest(kept).p AS point FROM f""")
def greedy_vetoes(spark, d):
    ensure_checkpoints(spark)
    return spatial.greedy_vetoes(_points(spark, d), "k", "point", 120.0).select("k", "point")


#: a mesh: triangle t of mesh m joins three of 60 places; vertices 0..119 repeat the places
_MESH = """v AS (SELECT DISTINCT p_partkey % 3 AS m, p_partkey % 120 AS v, (p_partkey % 60 * 13 % 50)::DOUBLE AS x, (p_partkey % 60 * 29 % 47)::DOUBLE AS y, (p_partkey % 60)::DOUBLE AS z FROM part),
tr AS (SELECT p_partkey % 3 AS m, p_partkey AS t, p_partkey % 120 AS a, (p_partkey + 3 * (1 + p_size % 4)) % 120 AS b, (p_partkey + 3 * (5 + p_size % 7)) % 120 AS c FROM part),
w AS (SELECT tr.m, t, a % 60 + CASE WHEN (a % 60) % 3 = tr.m THEN 0 ELSE 60 END AS a, b % 60 + CASE WHEN (b % 60) % 3 = tr.m THEN 0 ELSE 60 END AS b, c % 60 + CASE WHEN (c % 60) % 3 = tr.m THEN 0 ELSE 60 END AS c FROM tr), g AS (SELECT * FROM w WHERE a <> b AND b <> c AND a <> c),
e AS (SELECT m, t, least(a, b) AS u, greatest(a, b) AS v FROM g UNION ALL SELECT m, t, least(b, c), greatest(b, c) FROM g UNION ALL SELECT m, t, least(a, c), greatest(a, c) FROM g)"""


def _mesh(spark, d):
    c = F.col
    p = table(spark, d, "part")
    place = c("p_partkey") % 60
    v = p.select((c("p_partkey") % 3).alias("m"), (c("p_partkey") % 120).alias("v"), (place * 13 % 50).cast("double").alias("x"), (place * 29 % 47).cast("double").alias("y"), place.cast("double").alias("z")).distinct()
    t = p.select((c("p_partkey") % 3).alias("m"), c("p_partkey").alias("t"), (c("p_partkey") % 120).alias("a"), ((c("p_partkey") + 3 * (1 + c("p_size") % 4)) % 120).alias("b"), ((c("p_partkey") + 3 * (5 + c("p_size") % 7)) % 120).alias("c"))
    return spatial.weld(v, t, "m", 1.0)


@query(f"WITH {_MESH} SELECT m, t, a, b, c FROM g")
def welded_triangles(spark, d):
    return _mesh(spark, d)[1]


@query(f"WITH {_MESH} SELECT m, u, v, min(t) AS t FROM e GROUP BY 1, 2, 3 HAVING count(*) = 1")
def boundary_edges(spark, d):
    return spatial.boundary_edges(_mesh(spark, d)[1], "m")


@query(f"""WITH RECURSIVE {_MESH}, l AS (SELECT DISTINCT x.m, x.t AS s, y.t AS o FROM e x JOIN e y ON x.m = y.m AND x.u = y.u AND x.v = y.v), r(m, t, near) AS (SELECT m, t, t FROM g UNION SELECT r.m, r.t, l.o FROM r JOIN l ON l.m = r.m AND l.s = r.near),
n AS (SELECT m, t, min(near) AS region FROM r GROUP BY 1, 2), xy AS (SELECT m, v, x, y, z FROM v), ar AS (SELECT g.m, g.t, sqrt(pow((q.y - p.y) * (s.z - p.z) - (q.z - p.z) * (s.y - p.y), 2) + pow((q.z - p.z) * (s.x - p.x) - (q.x - p.x) * (s.z - p.z), 2) + pow((q.x - p.x) * (s.y - p.y) - (q.y - p.y) * (s.x - p.x), 2)) / 2 AS area FROM g JOIN xy p ON p.m = g.m AND p.v = g.a JOIN xy q ON q.m = g.m AND q.v = g.b JOIN xy s ON s.m = g.m AND s.v = g.c)
SELECT m, region, count(*) AS triangles, round(sum(area), 4) AS area FROM ar JOIN n USING (m, t) GROUP BY 1, 2""")
def region_areas(spark, d):
    ensure_checkpoints(spark)
    v, t = _mesh(spark, d)
    return spatial.region_areas(t, v, spatial.regions(t, "m"), "m").select("m", "region", "triangles", F.round("area", 4).alias("area"))


@query(f"WITH {_TRI} SELECT k, greatest(min(x) - 30, 10) AS x_min, greatest(min(y) - 30, 10) AS y_min, least(max(x) + 30, 1000) AS x_max, least(max(y) + 30, 1000) AS y_max FROM q GROUP BY 1")
def bounding_boxes(spark, d):
    return spatial.bounds(_points(spark, d), "k", 30.0, 10.0, 1000.0)


#: a road graph per map: roads of a part between neighbouring junctions
_ROADS = "g AS (SELECT p_partkey % 4 AS k, p_partkey AS edge, p_partkey % 4 + 4 * (p_partkey // 8 % 40) AS u, p_partkey % 4 + 4 * ((p_partkey // 8 + 1 + p_size % 3) % 40) + CASE WHEN p_partkey % 10 = 0 THEN 1000 ELSE 0 END AS v, p_retailprice AS weight FROM part)"


def _roads(spark, d):
    c = F.col
    block = F.floor(c("p_partkey") / 8)
    return table(spark, d, "part").select((c("p_partkey") % 4).alias("k"), c("p_partkey").alias("edge"), (c("p_partkey") % 4 + 4 * (block % 40)).alias("u"), (c("p_partkey") % 4 + 4 * ((block + 1 + c("p_size") % 3) % 40) + F.when(c("p_partkey") % 10 == 0, 1000).otherwise(0)).alias("v"), c("p_retailprice").alias("weight"))


@query(f"""WITH RECURSIVE {_ROADS}, b AS (SELECT k, u, v FROM g UNION SELECT k, v, u FROM g), r(k, id, near) AS (SELECT DISTINCT k, u, u FROM b UNION SELECT r.k, r.id, b.v FROM r JOIN b ON b.k = r.k AND b.u = r.near), n AS (SELECT k, id, min(near) AS part FROM r GROUP BY 1, 2),
s AS (SELECT g.*, part FROM g JOIN n ON n.k = g.k AND n.id = g.u), q AS (SELECT k, part FROM s GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY k ORDER BY sum(weight) DESC, part) = 1) SELECT s.k, s.edge FROM s JOIN q USING (k, part)""")
def largest_component(spark, d):
    ensure_checkpoints(spark)
    return graph.largest_component(_roads(spark, d), "k").select("k", "edge")


@query(f"""WITH RECURSIVE {_ROADS}, b AS (SELECT u, v, min(weight) AS w FROM (SELECT u, v, weight FROM g UNION ALL SELECT v, u, weight FROM g) GROUP BY 1, 2), r(node, dist, hops) AS (SELECT 0::BIGINT, 0::DOUBLE, 0 UNION ALL SELECT node, min(dist), min(hops) FROM (SELECT b.v AS node, r.dist + b.w AS dist, r.hops + 1 AS hops FROM r JOIN b ON b.u = r.node WHERE r.hops < 60) GROUP BY 1)
SELECT node, round(min(dist), 4) AS dist FROM r GROUP BY 1""")
def hop_distances(spark, d):
    ensure_checkpoints(spark)
    source = spark.range(1).select(F.col("id").alias("node"))
    return graph.hop_distances(_roads(spark, d), source).select("node", F.round("dist", 4).alias("dist"))


@query()
def covering_walks(spark, d):
    """Every road of the start's component is walked; the choice of roads is random by seed."""
    e = _roads(spark, d).select(F.col("k").cast("string").alias("map_id"), "edge", "u", "v", "weight")
    seeds = e.select("map_id").distinct().select("map_id", F.explode(F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))).alias("seed"))
    return graph.covering_walks(e, seeds)


_LEGS = "c AS (SELECT o_custkey AS k, unnest([1, 2]) AS leg, (o_orderkey * 5 % 360)::DOUBLE AS bearing, o_totalprice AS clearance, o_orderkey % 4 > 0 AS walkable, o_orderkey % 7 = 0 AS banned FROM orders)"


@query(f"""WITH {_LEGS}, f AS (SELECT * FROM c WHERE walkable AND NOT banned), a AS (SELECT k, bearing AS b1, clearance AS c1 FROM f WHERE leg = 1 QUALIFY row_number() OVER (PARTITION BY k ORDER BY clearance DESC, bearing) = 1),
b AS (SELECT f.k, f.bearing, f.clearance FROM f JOIN a ON a.k = f.k WHERE leg = 2 AND abs(((f.bearing - b1 + 540) % 360 + 360) % 360 - 180) BETWEEN 60 AND 150 QUALIFY row_number() OVER (PARTITION BY f.k ORDER BY f.clearance DESC, f.bearing) = 1)
SELECT a.k, b1 AS bearing1, c1 AS clearance1, b.bearing AS bearing2, b.clearance AS clearance2 FROM a LEFT JOIN b ON b.k = a.k""")
def best_legs(spark, d):
    c = F.col
    o = table(spark, d, "orders").withColumn("leg", F.explode(F.array(F.lit(1), F.lit(2))))
    cand = o.select(c("o_custkey").alias("k"), "leg", (c("o_orderkey") * 5 % 360).cast("double").alias("bearing"), c("o_totalprice").alias("clearance"), (c("o_orderkey") % 4 > 0).alias("walkable"), (c("o_orderkey") % 7 == 0).alias("banned"))
    return graph.best_legs(cand, "k", 60, 150)


@query("SELECT c_nationkey AS k, c_custkey AS region, c_acctbal AS centreline_m FROM customer WHERE c_custkey % 3 > 0 AND c_custkey % 50 >= 20 QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) = 1")
def longest_network(spark, d):
    c = F.col
    n = table(spark, d, "customer").select(c("c_nationkey").alias("k"), c("c_custkey").alias("region"), c("c_acctbal").alias("centreline_m"), (c("c_custkey") % 50).alias("area_m2"), F.when(c("c_custkey") % 3 == 0, "no road").alias("error"))
    return graph.longest_network(n, "k", 20)


@query("""WITH g AS (SELECT a, b, c FROM (SELECT unnest([0, 10, 20, 30, 40, 50]) AS a), (SELECT unnest([0, 2, 4, 6, 8]) AS b), (SELECT unnest([0.00, 0.02, 0.05, 0.08]::DOUBLE[]) AS c)),
p AS (SELECT a, b, c, sum(pow(l_quantity - a, 2)) + 10 * sum(pow(l_linenumber - b, 2)) + 1000 * sum(pow(l_discount - c, 2)) AS penalty FROM lineitem, g GROUP BY 1, 2, 3) SELECT a::DOUBLE AS a, b::DOUBLE AS b, c AS c, round(penalty, 2) AS penalty FROM p ORDER BY penalty LIMIT 1""")
def least_penalty(spark, d):
    """A penalty that is a sum over knobs, so the descent ends at the least of the whole grid."""
    c = F.col
    off = lambda col, v: F.sum(F.pow(c(col).cast("double") - v, 2))
    options = {"a": [0.0, 10.0, 20.0, 30.0, 40.0, 50.0], "b": [0.0, 2.0, 4.0, 6.0, 8.0], "c": [0.0, 0.02, 0.05, 0.08]}
    now, least, _ = graph.coordinate_descent(table(spark, d, "lineitem"), options, {"a": 0.0, "b": 0.0, "c": 0.0}, lambda s: off("l_quantity", s["a"]) + 10 * off("l_linenumber", s["b"]) + 1000 * off("l_discount", s["c"]))
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in now.items()], F.round(F.lit(least), 2).alias("penalty"))


#: a raster: cells a part covers in its map's 40 x 40 grid
_CELLS = "c AS (SELECT DISTINCT p_partkey % 4 AS m, (p_partkey * 7 + p_size) % 40 AS r, (p_partkey * 13 + p_size * 3) % 40 AS q FROM part)"


def _cells(spark, d):
    c = F.col
    return table(spark, d, "part").select((c("p_partkey") % 4).cast("string").alias("map_id"), ((c("p_partkey") * 7 + c("p_size")) % 40).cast("int").alias("row"), ((c("p_partkey") * 13 + c("p_size") * 3) % 40).cast("int").alias("col")).distinct()


@query(f"""WITH {_CELLS}, o AS (SELECT m, a AS r, b AS q FROM (SELECT DISTINCT m FROM c), (SELECT unnest(range(-1, 41)) AS a), (SELECT unnest(range(-1, 41)) AS b) EXCEPT SELECT m, r, q FROM c)
SELECT c.m::VARCHAR AS map_id, c.r::INT AS row, c.q::INT AS col, round(sqrt(min(pow(c.r - o.r, 2) + pow(c.q - o.q, 2))), 6) AS dist FROM c JOIN o USING (m) GROUP BY 1, 2, 3""")
def clearance(spark, d):
    return tiles.clearance(_cells(spark, d)).withColumn("dist", F.round("dist", 6))


@query(f"WITH {_CELLS} SELECT a.m::VARCHAR AS map_id, a.r::INT AS row, a.q::INT AS col, round(count(b.r) / 29.0, 6) AS density FROM c a LEFT JOIN c b ON b.m = a.m AND (b.r + b.q) % 3 = 0 AND pow(a.r - b.r, 2) + pow(a.q - b.q, 2) <= 9 GROUP BY 1, 2, 3")
def obstacle_density(spark, d):
    c = _cells(spark, d)
    return tiles.density(c, c.where((F.col("row") + F.col("col")) % 3 == 0), 3).withColumn("density", F.round("density", 6))


#: rasters of 22 x 23 cells, two fifths of them ground, one map for 256 order keys
_GROUND = "c AS (SELECT DISTINCT o_orderkey // 256 AS m, (o_orderkey * 7919 % 1009) % 22 AS r, (o_custkey * 31 + o_orderkey * 17) % 23 AS q FROM orders)"


def _ground(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, d, "orders").select(F.floor(k / 256).cast("string").alias("map_id"), (k * 7919 % 1009 % 22).cast("int").alias("row"), ((c * 31 + k * 17) % 23).cast("int").alias("col")).distinct()


@query()
def skeletons(spark, d):
    """Centre lines of the maps with the degree of each cell; thinning is iterative."""
    ensure_checkpoints(spark)
    return roads.degrees(tiles.thinned(_ground(spark, d), tile=16))


_DISC = "b AS (SELECT a, e FROM (SELECT unnest(range(-2, 3)) AS a), (SELECT unnest(range(-2, 3)) AS e) WHERE a * a + e * e <= 4)"


@query(f"""WITH {_CELLS}, {_DISC}, g AS (SELECT DISTINCT m, r + a AS r, q + e AS q FROM c, b)
SELECT p.m::VARCHAR AS map_id, p.r::INT AS row, p.q::INT AS col FROM g p, b JOIN g ON g.m = p.m AND g.r = p.r + b.a AND g.q = p.q + b.e GROUP BY 1, 2, 3 HAVING count(*) = (SELECT count(*) FROM b)""")
def closed_cells(spark, d):
    """Walkable cells closed by a disc; small tiles, so that the halo is at work."""
    return tiles.closed(_cells(spark, d), 2, tile=16)


_HOLES = """o AS (SELECT m, a AS r, b AS q FROM (SELECT DISTINCT m FROM c), (SELECT unnest(range(-1, 24)) AS a), (SELECT unnest(range(-1, 24)) AS b) EXCEPT SELECT m, r, q FROM c),
f(m, r, q) AS (SELECT m, r, q FROM o WHERE r = -1 AND q = -1 UNION SELECT o.m, o.r, o.q FROM f JOIN o ON o.m = f.m AND abs(o.r - f.r) + abs(o.q - f.q) = 1)"""


@query(f"WITH RECURSIVE {_GROUND}, {_HOLES} SELECT m::VARCHAR AS map_id, r::INT AS row, q::INT AS col FROM (SELECT * FROM o EXCEPT SELECT * FROM f)")
def hole_cells(spark, d):
    ensure_checkpoints(spark)
    return tiles.holes(_ground(spark, d), tile=16)


@query(f"""WITH RECURSIVE {_GROUND}, l(m, r, q, fr, fq) AS (SELECT m, r, q, r, q FROM c UNION SELECT l.m, l.r, l.q, c.r, c.q FROM l JOIN c ON c.m = l.m AND abs(c.r - l.fr) + abs(c.q - l.fq) = 1)
SELECT m::VARCHAR AS map_id, r::INT AS row, q::INT AS col, min((fr + 536870912) * 4294967296 + fq + 2147483648)::BIGINT AS component FROM l GROUP BY 1, 2, 3""")
def cell_components(spark, d):
    ensure_checkpoints(spark)
    return tiles.labelled(_ground(spark, d), tile=16)


@query(f"""WITH {_CELLS}, y AS (SELECT DISTINCT i, round_even(5 + t * sin(2 * pi() * i / 16), 0)::INT - 5 AS a, round_even(5 + t * cos(2 * pi() * i / 16), 0)::INT - 5 AS e FROM (SELECT unnest(range(16)) AS i), (SELECT unnest(range(1, 6)) AS t)),
h AS (SELECT DISTINCT c.m, c.r, c.q, y.i FROM c, y JOIN c w ON w.m = c.m AND w.r = c.r + y.a AND w.q = c.q + y.e AND (w.r + w.q) % 3 = 0), p AS (SELECT m, r, q, count(*) AS n FROM h JOIN h g USING (m, r, q) WHERE g.i = h.i + 8 GROUP BY 1, 2, 3)
SELECT c.m::VARCHAR AS map_id, c.r::INT AS row, c.q::INT AS col, coalesce(n, 0)::INT AS pairs FROM c LEFT JOIN p USING (m, r, q)""")
def enclosed_cells(spark, d):
    """Pairs of opposite rays that meet an obstacle: inside a street, not beside a wall."""
    c = _cells(spark, d)
    return tiles.opposing_pairs(c, c.where((F.col("row") + F.col("col")) % 3 == 0), 5, tile=16)


@query(f"""WITH RECURSIVE {_GROUND}, n AS (SELECT a.m, a.r, a.q, b.r AS s, b.q AS t FROM c a JOIN c b ON b.m = a.m AND abs(b.r - a.r) <= 1 AND abs(b.q - a.q) <= 1 AND (b.r <> a.r OR b.q <> a.q)),
g AS (SELECT c.m, c.r, c.q, count(n.s) AS deg FROM c LEFT JOIN n ON n.m = c.m AND n.r = c.r AND n.q = c.q GROUP BY 1, 2, 3),
w AS (SELECT m, 0 AS len, r AS fr, q AS fq, s AS sr, t AS sq, r AS pr, q AS pq, s AS r, t AS q, CASE WHEN r <> s AND q <> t THEN 1 ELSE 0 END AS dia, 1 AS k FROM n JOIN g USING (m, r, q) WHERE deg <> 2
UNION ALL SELECT w.m, 0, w.fr, w.fq, w.sr, w.sq, w.r, w.q, n.s, n.t, w.dia + CASE WHEN n.r <> n.s AND n.q <> n.t THEN 1 ELSE 0 END, w.k + 1 FROM w JOIN g ON g.m = w.m AND g.r = w.r AND g.q = w.q AND g.deg = 2 JOIN n ON n.m = w.m AND n.r = w.r AND n.q = w.q AND (n.s <> w.pr OR n.t <> w.pq))
SELECT w.m::VARCHAR AS map_id, fr::INT AS u_row, fq::INT AS u_col, w.r::INT AS v_row, w.q::INT AS v_col, round(k - dia + dia * sqrt(2), 6) AS length, (k + 1)::INT AS cells FROM w JOIN g ON g.m = w.m AND g.r = w.r AND g.q = w.q AND g.deg <> 2 WHERE (fr, fq, sr, sq) <= (w.r, w.q, pr, pq)""")
def road_edges(spark, d):
    ensure_checkpoints(spark)
    e = roads.road_edges(_ground(spark, d))
    return e.select("map_id", F.col("u.row").alias("u_row"), F.col("u.col").alias("u_col"), F.col("v.row").alias("v_row"), F.col("v.col").alias("v_col"), F.round("length", 6).alias("length"), F.size("cells").alias("cells"))


@query(f"""WITH RECURSIVE {_ROADS}, b AS (SELECT DISTINCT k, edge, u, v, round(weight * 100)::BIGINT AS w FROM (SELECT k, edge, u, v, weight FROM g UNION ALL SELECT k, edge, v, u, weight FROM g)),
t AS (SELECT DISTINCT k, u AS node FROM b WHERE edge % 97 = 0), s AS (SELECT DISTINCT k, u AS start FROM b WHERE u % 3 = 0),
r(k, node, dist, goal, hops) AS (SELECT k, node, 0::BIGINT, node, 0 FROM t UNION ALL SELECT k, node, min(dist), arg_min(goal, (dist, goal)), min(hops) FROM (SELECT b.k, b.u AS node, r.dist + b.w AS dist, r.goal, r.hops + 1 AS hops FROM r JOIN b ON b.k = r.k AND b.v = r.node WHERE r.hops < 60) GROUP BY 1, 2),
f AS (SELECT k, node, min(dist) AS dist, arg_min(goal, (dist, goal)) AS goal FROM r GROUP BY 1, 2),
o AS (SELECT b.k, b.u, arg_min((b.v, b.edge, b.w), (f.dist + b.w, f.goal, b.edge, b.v, b.w)) AS x FROM b JOIN f ON f.k = b.k AND f.node = b.v JOIN f h ON h.k = b.k AND h.node = b.u AND h.dist > 0 GROUP BY 1, 2),
p(k, start, step, u, v, edge, weight) AS (SELECT s.k, start, 1, o.u, o.x[1], o.x[2], o.x[3] FROM s JOIN o ON o.k = s.k AND o.u = s.start UNION ALL SELECT p.k, p.start, p.step + 1, o.u, o.x[1], o.x[2], o.x[3] FROM p JOIN o ON o.k = p.k AND o.u = p.v)
SELECT * FROM p""")
def ways_to_nearest(spark, d):
    """The way from each start to the nearest junction with an unwalked road."""
    ensure_checkpoints(spark)
    e = _roads(spark, d).withColumn("weight", F.round(F.col("weight") * 100).cast("long"))
    ends = e.select("k", "edge", F.explode(F.array("u", "v")).alias("node"))
    return roads.ways_to_nearest(e, "k", ends.where("node % 3 = 0").select("k", F.col("node").alias("start")), ends.where("edge % 97 = 0"))


_PX = "x AS (SELECT vec_id, unnest(list_transform(embedding, lambda e: least(greatest(floor(e::DOUBLE * 400 + 128), 0), 255)::INT)) AS v FROM embeddings)"


@query(f"""WITH {_PX}, h AS (SELECT vec_id, v, count(*) AS c FROM x GROUP BY 1, 2), k AS (SELECT *, sum(c) OVER (PARTITION BY vec_id ORDER BY v) AS cum, sum(c) OVER (PARTITION BY vec_id) AS n FROM h)
SELECT vec_id, round(sum(v * c) / any_value(n), 6) AS mean_y, min(v) FILTER (cum >= 0.1 * n) AS p10, min(v) FILTER (cum >= 0.5 * n) AS p50, min(v) FILTER (cum >= 0.99 * n) AS p99, round(coalesce(sum(c) FILTER (v >= 250), 0) / any_value(n), 6) AS blown_frac, round(coalesce(sum(c) FILTER (v <= 5), 0) / any_value(n), 6) AS black_frac FROM k GROUP BY 1""")
def picture_stats(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.least(F.greatest(F.floor(x.cast("double") * 400 + 128), F.lit(0)), F.lit(255)).cast("int")).alias("luma"))
    s = rasters.picture_stats(e, ["vec_id"])
    return s.withColumns({n: F.round(n, 6) for n in ("mean_y", "blown_frac", "black_frac")})


@query("""WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE * 10 AS z FROM embeddings) SELECT vec_id, round(count(*) FILTER (z * 100 + 128 < 8) / count(*), 6) AS dark_frac, round(CASE WHEN count(*) FILTER (z > 0) > 0 THEN count(*) FILTER (z > 0 AND z < 0.6) / count(*) FILTER (z > 0) ELSE 0 END, 6) AS near_frac, round(count(*) FILTER (z > 0) / count(*), 6) AS valid_frac, coalesce(count(*) FILTER (z > 0 AND z < 0.6) / nullif(count(*) FILTER (z > 0), 0), 0) > 0.5 AS buried FROM x GROUP BY 1""")
def look_stats(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double") * 10).alias("z")).withColumn("y", F.transform("z", lambda z: z * 100 + 128))
    s = rasters.look_stats(e, "y", "z").select("vec_id", "dark_frac", "near_frac", "valid_frac", "buried")
    return s.withColumns({n: F.round(n, 6) for n in ("dark_frac", "near_frac", "valid_frac")})


@query("""WITH p AS (SELECT l_suppkey AS frame, l_partkey % 100 AS x, l_orderkey % 100 AS y, l_quantity AS depth, l_discount * 300 AS diff, l_extendedprice AS luma FROM lineitem), r AS (SELECT 'wall' AS region, 10 AS x0, 10 AS y0, 60 AS x1, 90 AS y1 UNION ALL SELECT 'roof', 40, 0, 100, 20)
SELECT frame, region, count(*) AS n, CASE WHEN count(*) >= 20 THEN round(avg(diff), 6) END AS residual, CASE WHEN count(*) >= 20 THEN round(100.0 * count(*) FILTER (diff > 20) / count(*), 6) END AS sparkle, CASE WHEN count(*) >= 20 THEN round(avg(luma), 4) END AS luma FROM p JOIN r ON x >= x0 AND x < x1 AND y >= y0 AND y < y1 WHERE depth BETWEEN 5 AND 40 GROUP BY 1, 2""")
def masked_metrics(spark, d):
    c = F.col
    p = table(spark, d, "lineitem").select(c("l_suppkey").alias("frame"), (c("l_partkey") % 100).alias("x"), (c("l_orderkey") % 100).alias("y"), c("l_quantity").alias("depth"), (c("l_discount") * 300).alias("diff"), c("l_extendedprice").alias("luma"))
    m = rasters.masked_metrics(p, ["frame"], {"wall": (10, 10, 60, 90), "roof": (40, 0, 100, 20)}, 5.0, 40.0, 20)
    return m.withColumns({"residual": F.round("residual", 6), "sparkle": F.round("sparkle", 6), "luma": F.round("luma", 4)})


@query("""WITH a AS (SELECT DISTINCT l_orderkey AS f, l_linenumber AS r, l_suppkey AS c, l_quantity - 20 AS z FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_suppkey ORDER BY l_quantity) = 1), b AS (SELECT f, r, c, CASE WHEN (f + r) % 3 = 0 THEN z ELSE z - 1 END AS z FROM a)
SELECT f, round(count(*) FILTER (a.z = b.z) / count(*), 6) AS equal, round(count(*) FILTER ((a.z > 0) = (b.z > 0)) / count(*), 6) AS valid_equal, max(CASE WHEN a.z > 0 AND b.z > 0 THEN abs(a.z - b.z) END) AS max_diff, round(quantile_cont(CASE WHEN a.z > 0 AND b.z > 0 THEN abs(a.z - b.z) END, 0.99), 6) AS p99_diff FROM a JOIN b USING (f, r, c) GROUP BY 1""")
def depth_agreement(spark, d):
    c = F.col
    a = table(spark, d, "lineitem").groupBy(c("l_orderkey").alias("f"), c("l_linenumber").alias("r"), c("l_suppkey").alias("c")).agg((F.min("l_quantity") - 20).alias("z"))
    b = a.withColumn("z", F.when((c("f") + c("r")) % 3 == 0, c("z")).otherwise(c("z") - 1))
    r = rollups.depth_agreement(a, b, ["f", "r", "c"])
    return r.withColumns({n: F.round(n, 6) for n in ("equal", "valid_equal", "p99_diff")})


@query("""WITH p AS (SELECT o_custkey AS k, o_orderkey AS x, (o_orderkey % 50)::DOUBLE AS y FROM orders), a AS (SELECT k, x, y, sum(coalesce(d, 0)) OVER (PARTITION BY k ORDER BY x ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2)) AS d FROM p WINDOW w AS (PARTITION BY k ORDER BY x))),
t AS (SELECT k, max(s) AS total, greatest(2, round_even(max(s) / 500, 0)::INT + 1) AS n FROM a GROUP BY 1 HAVING max(s) > 0) SELECT k, count(*) AS n, round(any_value(total), 4) AS total FROM (SELECT k, total, unnest(range(n)) AS i FROM t) GROUP BY 1""")
def resampled_paths(spark, d):
    c = F.col
    p = table(spark, d, "orders").select(c("o_custkey").alias("k"), c("o_orderkey").cast("double").alias("x"), (c("o_orderkey") % 50).cast("double").alias("y"))
    r = sequence.resample(sequence.arc_length(p, "k", ["x"], "x", "y"), "k", "x", "y", "arc", 500.0)
    return r.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("s"), 4).alias("total"))


@query("""WITH x AS (SELECT vec_id // 50 AS e, vec_id % 50 AS f, list_filter(list_transform(embedding, lambda v: v::DOUBLE * 4), lambda z: z > 0) AS z FROM embeddings WHERE vec_id % 50 % 2 = 0),
n AS (SELECT e, f, list_min(z) AS nearest, len(list_filter(z, lambda v: v < 0.6)) / len(z) > 0.84 AS bad FROM x WHERE len(z) > 0), b AS (SELECT e, f, CASE WHEN f - lag(f) OVER (PARTITION BY e ORDER BY f) <= 4 THEN 0 ELSE 1 END AS new FROM n WHERE bad),
r AS (SELECT e, f, sum(new) OVER (PARTITION BY e ORDER BY f) AS run FROM b), g AS (SELECT e, run, count(*) AS c, min(f) AS lo, max(f) AS hi FROM r GROUP BY 1, 2), h AS (SELECT e, sum(c)::BIGINT AS c, string_agg(lo || '-' || hi, ',' ORDER BY lo) AS events FROM g GROUP BY 1)
SELECT n.e AS episode_id, round(min(nearest), 6) AS nearest, count(*) FILTER (nearest <= 0.11) AS at_clip, coalesce(any_value(h.c), 0) AS penetrating_frames, coalesce(any_value(events), '') AS events FROM n LEFT JOIN h USING (e) GROUP BY 1""")
def penetrations(spark, d):
    """Vectors as depth pictures; the share is a larger one here, as most entries are small."""
    c = F.col
    z = table(spark, d, "embeddings").select(F.floor(c("vec_id") / 50).alias("episode_id"), (c("vec_id") % 50).alias("frame_id"), F.transform("embedding", lambda v: v.cast("double") * 4).alias("depth"))
    p = evidence.penetrations(z, share=0.84)
    return p.select("episode_id", F.round("nearest", 6).alias("nearest"), "at_clip", "penetrating_frames", F.array_join(F.transform("events", lambda e: F.concat_ws("-", e["first"].cast("string"), e["last"].cast("string"))), ",").alias("events"))


@query("""WITH p AS (SELECT vec_id // 50 AS e, vec_id % 50 AS f, CASE WHEN vec_id % 17 <> 0 THEN list_transform(embedding, lambda v, i: CASE WHEN vec_id % 11 < 2 THEN 7 + (i % 2) * (vec_id % 11) * 9 WHEN vec_id % 50 % 12 = 1 AND vec_id % 3 = 0 THEN 200 ELSE floor(v::DOUBLE * 100 + 128) END) END AS l, 640 + vec_id % 17 AS w FROM embeddings),
m AS (SELECT p.*, f % 8 <> 0 AND lead(f) OVER (PARTITION BY e ORDER BY f) IS NOT NULL AS pair FROM p), q AS (SELECT m.e, m.f, m.l, m.w, m.pair, n.l AS nl FROM m LEFT JOIN p n ON n.e = m.e AND n.f = m.f + 1 WHERE m.f % 3 = 0)
SELECT e AS episode_id, count(l) AS decoded, count(*) FILTER (l IS NULL) + count(*) FILTER (l IS NOT NULL AND pair AND nl IS NULL) AS unreadable, count(*) FILTER (list_max(l) - list_min(l) < 2) AS blank,
count(*) FILTER (pair AND list_sum(list_transform(list_zip(l, nl), lambda x: abs(x[1] - x[2]))) / len(l) < 0.05) AS duplicate_pairs, arg_min(w, f) FILTER (l IS NOT NULL) AS width FROM q GROUP BY 1""")
def picture_evidence(spark, d):
    """Vectors as pictures: some not readable, some of one grey, some like their neighbours; the camera rests at every eighth frame."""
    c = F.col
    v = table(spark, d, "embeddings")
    k = c("vec_id")
    grey = F.transform("embedding", lambda x, i: F.when(k % 11 < 2, 7 + ((i + 1) % 2) * (k % 11) * 9).when((k % 50 % 12 == 1) & (k % 3 == 0), 200).otherwise(F.floor(x.cast("double") * 100 + 128)))
    rows = v.select(F.floor(k / 50).alias("episode_id"), (k % 50).alias("frame_id"), F.when(k % 17 != 0, grey).alias("luma"), (640 + k % 17).alias("width"), F.lit(480).alias("height"))
    at = F.when(c("frame_id") % 8 == 1, c("frame_id") - 1).otherwise(c("frame_id")).cast("double")
    frames = rows.select("episode_id", "frame_id", at.alias("desired_x_cm"), *[F.lit(0.0).alias(n) for n in evidence.DESIRED[1:]])
    return evidence.picture_samples(frames, rows, 3).drop("height")
