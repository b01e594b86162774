"""Registered queries over manifests, results, reviews and samples: orders stand in for maps, lineitem for their levels or attempts."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strideframe.functions import geometry as G
from strideframe.functions import scalars as S
from strideframe.operators import classify, graph, rollups, status
from strideframe.plans.queries import EV, _events, query
from strideframe.session import table
from strideframe.sources import documents, listing
from strideframe.streaming import leases

#: a map's result by its number k; both engines read the same text
RESULT = {
    "state": "CASE k % 9 WHEN 0 THEN 'geometry_pass' WHEN 1 THEN 'blocked_asset' WHEN 2 THEN 'timeout' WHEN 3 THEN 'route_failed' WHEN 4 THEN 'coverage_review' WHEN 5 THEN 'failed' WHEN 6 THEN 'timeout' WHEN 7 THEN 'route_failed' END",
    "slug": "CASE WHEN k % 31 = 0 THEN 'Game_Traditional_Map' ELSE concat('Game_', CAST(k AS VARCHAR(20))) END",
    "kept": "CASE WHEN k % 5 = 0 THEN NULL ELSE CAST(k % 40 AS DOUBLE) / 40 END",
    "error": "CASE k % 7 WHEN 0 THEN 'RpcTimeout after connect' WHEN 1 THEN 'no usable road network' WHEN 2 THEN 'blocked at the agent height' WHEN 3 THEN 'sky-light missing' WHEN 4 THEN 'depth probe' END",
    "attempt": "CASE WHEN k % 3 = 0 THEN NULL ELSE k % 3 - 1 END", "note": "CASE WHEN k % 2 = 0 THEN 'start point not found' ELSE '' END",
    "clamped": "CASE WHEN k % 10 = 8 THEN 2 END", "sky": "k % 4", "centreline_m": "CASE WHEN k % 6 = 0 THEN NULL ELSE CAST(k % 120 AS DOUBLE) END",
    "excluded": "k % 41 = 0", "dropped": "k % 37 = 0", "recorded": "k % 29 = 0", "tried": "k % 2 = 0", "frames": "CASE WHEN k % 11 = 0 THEN 100 END",
}
_R = "r AS (SELECT o_orderkey AS k, o_totalprice AS price, o_custkey AS cust, " + ", ".join(f"{v} AS {n}" for n, v in RESULT.items()) + " FROM (SELECT *, o_orderkey AS k FROM orders))"
_GATES = "CASE k % 6 WHEN 0 THEN ['action_mix_in_band'] WHEN 1 THEN ['collision_free', 'depth_probe_clear'] WHEN 2 THEN ['depth_probe_clear'] WHEN 3 THEN ['network_too_short'] ELSE [] END"
_PHASES = "CASE k % 4 WHEN 0 THEN [] WHEN 1 THEN ['look_up'] WHEN 2 THEN ['look_up', 'forward'] ELSE ['forward'] END"


def _results(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("cust"))
    words = lambda *w: F.array(*map(F.lit, w)) if w else F.array().cast("array<string>")
    pick = lambda n, options, rest: F.coalesce(*[F.when(F.col("k") % n == i, v) for i, v in options.items()], rest)
    gates = pick(6, {0: words("action_mix_in_band"), 1: words("collision_free", "depth_probe_clear"), 2: words("depth_probe_clear"), 3: words("network_too_short")}, words())
    phases = pick(4, {0: words(), 1: words("look_up"), 2: words("look_up", "forward")}, words("forward"))
    return o.select("*", *[F.expr(v).alias(n) for n, v in RESULT.items()], gates.alias("gates"), phases.alias("sky_phases")).withColumn("failed", F.col("gates"))


@query(f"""WITH {_R}, x AS (SELECT *, {_GATES} AS gates, {_PHASES} AS phases FROM r)
SELECT k, CASE WHEN state = 'geometry_pass' THEN 'passed' WHEN state = 'blocked_asset' OR slug LIKE '%Traditional_Map' OR list_contains(gates, 'action_mix_in_band') OR kept < 0.1 THEN 'drop' WHEN state = 'timeout' AND error LIKE '%RpcTimeout%' THEN 'retry'
WHEN state = 'route_failed' AND coalesce(attempt, 0) = 0 AND note LIKE '%start point%' THEN 'retry' WHEN state = 'coverage_review' OR list_contains(gates, 'collision_free') OR coalesce(clamped, 0) > 0 THEN 'clearance45'
WHEN gates = ['depth_probe_clear'] AND len(phases) > 0 AND len(list_filter(phases, lambda p: p <> 'look_up')) = 0 THEN 'lookup10' WHEN gates = ['depth_probe_clear'] AND sky > 0 AND len(list_filter(phases, lambda p: p <> 'look_up')) > 0 THEN 'indoor_sky' WHEN gates = ['depth_probe_clear'] THEN 'lookup10' WHEN state = 'timeout' THEN 'clearance45' ELSE 'review' END AS category FROM x""")
def rerun_plan(spark, d):
    return _results(spark, d).select("k", classify.rerun_category().alias("category"))


_LEVEL = f"""CASE WHEN excluded THEN 'F' WHEN state = 'geometry_pass' OR recorded THEN 'A' WHEN state = 'coverage_review' THEN 'B' WHEN state IN ('failed', 'timeout') THEN 'C'
WHEN state IN ('route_failed', 'blocked_asset') THEN CASE WHEN dropped OR list_contains({_GATES}, 'network_too_short') OR centreline_m < 50 OR error LIKE '%no usable road network%' OR error LIKE '%blocked at the agent%' THEN 'G' ELSE 'D' END WHEN tried THEN 'E' ELSE 'H' END"""


@query(f"WITH {_R} SELECT k, {_LEVEL} AS cls FROM r")
def level_classes(spark, d):
    return _results(spark, d).select("k", classify.level_class().alias("cls"))


@query(f"WITH {_R}, l AS (SELECT cust, price, {_LEVEL} AS cls FROM r) SELECT cust, count(*) AS levels, count(*) FILTER (cls = 'A') AS n_best, round(coalesce(sum(price) FILTER (cls = 'A'), 0), 2) AS hours, min(cls) AS cls FROM l GROUP BY 1")
def pack_rollup(spark, d):
    l = _results(spark, d).withColumn("cls", classify.level_class())
    return rollups.pack_rollup(l, "cust", "cls", list("ABCDEFGH"), "price").withColumn("hours", F.round("hours", 2))


_STATUS = f"CASE WHEN k % 8 = 0 AND k % 3 = 0 THEN 'mend_start' WHEN k % 8 IN (0, 1) THEN 'needs_full_route' WHEN kept < 0.75 THEN 'check_missing_roads' WHEN len({_GATES}) > 0 THEN 'prechecks_failed' ELSE 'candidate' END"


@query(f"WITH {_R} SELECT k, coalesce(CASE WHEN k % 10 = 0 THEN 'reviewed' END, {_STATUS}) AS status FROM r")
def route_status(spark, d):
    r = _results(spark, d).withColumns({"route_kind": F.when(F.col("k") % 8 == 0, "none").when(F.col("k") % 8 == 1, "short_route").otherwise("planned"), "unmeasured": F.col("k") % 3 == 0, "failed_prechecks": F.col("gates")})
    reviews = r.where("k % 10 = 0").select("k", F.lit("reviewed").alias("status"))
    return status.overlay(r.select("k", classify.route_status().alias("status")), reviews, "k", {})


@query(f"WITH {_R} SELECT k, CASE WHEN frames > 0 THEN 'keep' WHEN error LIKE '%sky-light%' THEN 'lighting' WHEN error LIKE '%depth%' THEN 'reseed' ELSE 'retry' END AS cls FROM r")
def requeue_classes(spark, d):
    return _results(spark, d).select("k", classify.requeue_class().alias("cls"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_quantity <= 40 AND l_suppkey <= 60 AND l_suppkey > 0 AND l_linenumber * 10 - l_quantity <= 40 AND l_linenumber * 10 + l_quantity >= 20 AND 4 * l_quantity * l_suppkey / 1e4 >= 0.02 AND l_partkey % 3 = 2")
def solid_footprints(spark, d):
    l = table(spark, d, "lineitem")
    a = l.withColumns({"ext_x": F.col("l_quantity"), "ext_y": F.col("l_suppkey").cast("double"), "ext_z": F.col("l_quantity"), "z": F.col("l_linenumber") * 10.0, "class": F.when(F.col("l_partkey") % 3 == 0, "BP_SkyDome").when(F.col("l_partkey") % 3 == 1, "PointLight").otherwise("House")})
    return a.where(classify.solid_footprint(20.0, 40.0, 60.0, 0.02) & (F.col("ext_x") <= 40)).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity - l_discount * 100 <= 30 AND l_quantity + l_tax * 100 >= 25")
def interval_overlap(spark, d):
    return table(spark, d, "lineitem").where(classify.overlaps(F.col("l_quantity") - F.col("l_discount") * 100, F.col("l_quantity") + F.col("l_tax") * 100, F.lit(25), F.lit(30))).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT event_id FROM events WHERE value >= 40 AND coalesce(CASE WHEN event_id % 3 > 0 THEN value / 2 END, 0) >= 30")
def keep_clips(spark, d):
    e = table(spark, d, "events").withColumns({"edge": F.col("value"), "motion": F.when(F.col("event_id") % 3 > 0, F.col("value") / 2)})
    return e.where(classify.keep_clip(40, 30)).select("event_id")


@query("SELECT doc_id FROM documents WHERE lang = 'en' OR source = 'en'")
def tagged_clips(spark, d):
    c = table(spark, d, "documents").withColumns({"move": F.create_map("lang", F.lit(1)), "speeds": F.when(F.col("doc_id") % 2 == 0, F.create_map("source", F.lit(1)))})
    return c.where(classify.tagged("en")).select("doc_id")


@query("SELECT doc_id FROM documents WHERE try_cast(CASE doc_id % 3 WHEN 0 THEN source WHEN 1 THEN doc_id::VARCHAR ELSE '1e3' END AS DOUBLE) IS NOT NULL")
def numeric_positions(spark, d):
    t = table(spark, d, "documents").withColumn("x", F.when(F.col("doc_id") % 3 == 0, F.col("source")).when(F.col("doc_id") % 3 == 1, F.col("doc_id").cast("string")).otherwise("1e3"))
    return t.where(classify.numeric("x")).select("doc_id")


@query("""SELECT o_orderkey AS k, coalesce(CASE WHEN o_orderstatus = 'F' THEN 'done' END, CASE WHEN c.t IS NULL THEN 'queued' WHEN 1706600000 - c.t < 1800 * 100 THEN c.phase ELSE 'stale' END) AS state, CASE WHEN o_orderstatus <> 'F' THEN c.worker END AS worker, CASE WHEN o_orderstatus <> 'F' THEN 1706600000 - c.t END AS age_s
FROM orders LEFT JOIN (SELECT user_id AS k, max(epoch_us(ts) / 1e6) AS t, max(event_id)::VARCHAR AS worker, 'route' AS phase FROM events GROUP BY 1) c ON c.k = o_orderkey""")
def queue_status(spark, d):
    o = table(spark, d, "orders").withColumnRenamed("o_orderkey", "k")
    claims = _events(spark, d).groupBy(F.col("user_id").alias("k")).agg(F.max("event_id").cast("string").alias("worker"), F.max("sec").alias("heartbeat_epoch")).withColumn("phase", F.lit("route"))
    return status.queue_status(o, o.where("o_orderstatus = 'F'").select("k", F.lit("done").alias("state")), claims, "k", 1706600000.0, 180000)


@query("SELECT c_custkey, coalesce(l.phone, c_name) AS c_name, coalesce(l.state, 'queued') AS state, l.n FROM customer LEFT JOIN (SELECT o_custkey, CASE WHEN count(*) > 12 THEN 'many' END AS phone, CASE WHEN count(*) > 9 THEN 'done' END AS state, count(*) AS n FROM orders GROUP BY 1) l ON o_custkey = c_custkey")
def result_overlay(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", F.lit(None).cast("string").alias("state"))
    n = F.count(F.lit(1))
    r = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.when(n > 12, "many").alias("c_name"), F.when(n > 9, "done").alias("state"), n.alias("n"))
    return status.overlay(c, r, "c_custkey", {"state": "queued"})


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 0.0 ELSE p_retailprice END AS price FROM part WHERE p_partkey % 5 > 0 UNION ALL SELECT p_partkey, 0.0 FROM part WHERE p_partkey % 5 = 0 AND p_partkey % 3 = 0")
def shard_upsert(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.col("p_retailprice").alias("price"))
    return status.upsert(p.where("p_partkey % 5 > 0"), p.where("p_partkey % 3 = 0").withColumn("price", F.lit(0.0)), "p_partkey")


@query("SELECT o_orderkey AS shard, CASE WHEN o_orderkey % 4 = 1 THEN 'lv_' || o_orderkey WHEN o_orderkey % 4 = 2 THEN 'lv_b' END AS episode, CASE WHEN o_orderkey % 4 IN (1, 2) THEN o_orderkey * 10 END AS frames, CASE WHEN o_orderkey % 4 = 1 THEN true END AS accepted, CASE WHEN o_orderkey % 4 IN (0, 3) THEN 'no episode for this shard' END AS error FROM orders")
def beacon_rows(spark, d):
    k = F.col("o_orderkey")
    one = lambda e, extra="": F.format_string('{"episode": "%s", "contiguous_frames": %d' + extra + "}", e, k * 10)
    name = F.concat(F.lit("lv_"), k.cast("string"))
    body = F.when(k % 4 == 1, F.concat(F.lit("["), one(F.lit("other")), F.lit(", "), one(name, ', "accepted": true'), F.lit("]"))).when(k % 4 == 2, one(F.lit("lv_b"))).when(k % 4 == 3, one(F.lit("zz"))).otherwise(F.lit("[]"))
    b = table(spark, d, "orders").select(k.alias("shard"), body.alias("body"))
    return status.beacon_rows(b, "shard", "body", "lv_").select("shard", "episode", "frames", "accepted", "error")


@query("SELECT n_nationkey, slug, s_suppkey FROM (SELECT n_nationkey, unnest([n_nationkey::VARCHAR, (n_nationkey + 100)::VARCHAR]) AS slug FROM nation) LEFT JOIN (SELECT s_suppkey, s_suppkey::VARCHAR AS slug FROM supplier) USING (slug)")
def project_levels(spark, d):
    n = F.col("n_nationkey")
    projects = table(spark, d, "nation").select("n_nationkey", F.concat(n.cast("string"), F.lit("; "), (n + 100).cast("string"), F.lit(";")).alias("levels"))
    return status.project_levels(projects, table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("slug"), "s_suppkey"), "n_nationkey", "levels").select("n_nationkey", "slug", "s_suppkey")


@query("SELECT n_nationkey, slug FROM nation LEFT JOIN (SELECT c_nationkey, c_custkey AS slug, row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE 1 END, coalesce(CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END, 0) DESC, c_custkey) AS rn FROM customer) ON c_nationkey = n_nationkey AND rn = 1")
def representative_levels(spark, d):
    c = table(spark, d, "customer")
    levels = c.select(F.col("c_custkey").alias("slug"), (F.col("c_custkey") % 10 == 0).alias("recorded"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_acctbal")).alias("core"))
    listed = table(spark, d, "nation").join(c.select(F.col("c_nationkey").alias("n_nationkey"), F.col("c_custkey").alias("slug")), "n_nationkey", "left")
    return status.representative(listed.select("n_nationkey", "slug"), levels, "n_nationkey", "core")


@query("SELECT o_orderkey, c_mktsegment AS segment, coalesce(array_to_string(list_filter([c_mktsegment, c_nationkey::VARCHAR], lambda p: p NOT LIKE 'B%'), ','), '') AS packs FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) ON c_custkey = o_custkey")
def enriched_manifest(spark, d):
    other = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"), F.array("c_mktsegment", F.col("c_nationkey").cast("string")).alias("packs"))
    e = status.enrich(table(spark, d, "orders").select("o_orderkey", "o_custkey"), other, "o_custkey", "packs", lambda p: ~p.startswith("B"))
    return e.select("o_orderkey", "segment", F.array_join("packs", ",").alias("packs"))


@query("SELECT k, source FROM (SELECT k, source, row_number() OVER (PARTITION BY k ORDER BY p) AS rn FROM (SELECT p_partkey AS k, 'small' AS source, 0 AS p FROM part WHERE p_size < 10 UNION ALL SELECT p_partkey, 'cheap', 1 FROM part WHERE p_retailprice < 1200 UNION ALL SELECT p_partkey, 'any', 2 FROM part)) WHERE rn = 1")
def prioritised_candidates(spark, d):
    p = table(spark, d, "part").withColumnRenamed("p_partkey", "k")
    return status.prioritised([("small", p.where("p_size < 10").select("k")), ("cheap", p.where("p_retailprice < 1200").select("k")), ("any", p.select("k"))], "k").select("k", "source")


@query(f"WITH {_R}, x AS (SELECT k, {_GATES} AS g FROM r) SELECT k, array_to_string(list_filter(g, lambda v: NOT list_contains(['collision_free', 'depth_probe_clear'], v)), ',') AS others, len(list_filter(g, lambda v: NOT list_contains(['collision_free', 'depth_probe_clear'], v))) = 0 AS only_route FROM x")
def subset_test(spark, d):
    others = F.array_except("gates", F.array(F.lit("collision_free"), F.lit("depth_probe_clear")))
    return _results(spark, d).select("k", F.array_join(others, ",").alias("others"), (F.size(others) == 0).alias("only_route"))


@query("SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_totalprice > 250000 INTERSECT SELECT user_id FROM events WHERE event_type = 'click'")
def index_intersection(spark, d):
    k = lambda t, c, where="true": table(spark, d, t).where(where).select(F.col(c).alias("k"))
    return k("customer", "c_custkey").intersect(k("orders", "o_custkey", "o_totalprice > 250000")).intersect(k("events", "user_id", "event_type = 'click'"))


#: attempts of a map: the orders of a customer by number; the chosen one is named on the map
_ATT = "a AS (SELECT o_custkey AS k, o_orderkey AS attempt, o_totalprice AS price, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)"


def _attempts(spark, d):
    return table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("attempt"), F.col("o_totalprice").alias("price")))).alias("attempts"))


@query(f"WITH {_ATT} SELECT k, coalesce(max(attempt) FILTER (attempt % 7 = 0 AND first7), max(attempt) FILTER (i = n)) AS latest FROM (SELECT *, attempt = min(CASE WHEN attempt % 7 = 0 THEN attempt END) OVER (PARTITION BY k) AS first7 FROM a) GROUP BY k")
def chosen_attempts(spark, d):
    a = _attempts(spark, d).withColumn("chosen", F.array_min(F.filter(F.transform("attempts", lambda x: x["attempt"]), lambda v: v % 7 == 0)))
    return a.select("k", rollups.chosen_attempt(F.col("attempts"), F.col("chosen"))["attempt"].alias("latest"))


@query(f"WITH {_ATT} SELECT k, coalesce(min(attempt) FILTER (price > 300000), max(attempt)) AS best FROM a GROUP BY k")
def first_go_or_last(spark, d):
    return _attempts(spark, d).select("k", rollups.first_or_last(F.col("attempts"), lambda x: x["price"] > 300000)["attempt"].alias("best"))


@query("SELECT l_returnflag, l_linestatus, metric, round(median(v), 6) AS median FROM (SELECT l_returnflag, l_linestatus, unnest(['quantity', 'discount']) AS metric, unnest([l_quantity, l_discount]) AS v FROM lineitem) GROUP BY 1, 2, 3")
def region_medians(spark, d):
    s = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"))
    return rollups.region_medians(s, ["l_returnflag", "l_linestatus"], ["quantity", "discount"]).withColumn("median", F.round("median", 6))


_SCORE = "CASE WHEN l_tax <= 0.07 AND l_discount <= 0.09 THEN l_tax + l_discount + abs(l_quantity * 4 - 120) / 400.0 END"


@query(f"WITH s AS (SELECT l_suppkey AS k, l_linenumber AS ev, {_SCORE} AS s FROM lineitem), p AS (SELECT k, ev, quantile_cont(s, 0.5) AS score, count(*) = count(s) AS ok FROM s GROUP BY 1, 2) SELECT k, arg_min(ev, (score, ev)) FILTER (ok) AS best, round(min(score) FILTER (ok), 9) AS score FROM p GROUP BY k")
def best_exposure(spark, d):
    c = F.col
    s = table(spark, d, "lineitem").select(c("l_suppkey").alias("k"), c("l_linenumber").alias("ev"), c("l_tax").alias("blown_frac"), c("l_discount").alias("black_frac"), (c("l_quantity") * 4).alias("p50"))
    return rollups.best_exposure(s, "k", "ev", most_blown=0.07, most_black=0.09).withColumn("score", F.round("score", 9))


@query("SELECT l_returnflag AS variant, round(avg(l_quantity), 6) AS mean, median(l_suppkey % 50) AS p10, median(l_quantity) AS p50, median(l_partkey % 99) AS p99, round(median(l_tax), 6) AS blown, max(l_tax) AS blown_max, round(median(l_discount), 6) AS black, max(l_discount) AS black_max, round(quantile_cont(l_quantity, 0.95) - quantile_cont(l_quantity, 0.05), 6) AS mean_spread FROM lineitem GROUP BY 1")
def brightness_rollup(spark, d):
    c = F.col
    s = table(spark, d, "lineitem").select(c("l_returnflag").alias("variant"), c("l_quantity").alias("mean_y"), (c("l_suppkey") % 50).alias("p10"), c("l_quantity").alias("p50"), (c("l_partkey") % 99).alias("p99"), c("l_tax").alias("blown_frac"), c("l_discount").alias("black_frac"))
    r = rollups.brightness_rollup(s, "variant")
    return r.withColumns({n: F.round(n, 6) for n in ("mean", "blown", "black", "mean_spread")})


@query("SELECT o_orderpriority, o_orderstatus = 'F' AS done, count(o_totalprice) AS n, min(o_totalprice) AS low, round(quantile_cont(o_totalprice, 0.1), 6) AS p10, round(median(o_totalprice), 6) AS median, round(quantile_cont(o_totalprice, 0.9), 6) AS p90, max(o_totalprice) AS high FROM orders GROUP BY 1, 2")
def height_deltas(spark, d):
    o = table(spark, d, "orders").withColumn("done", F.col("o_orderstatus") == "F")
    r = rollups.five_numbers(o, ["o_orderpriority", "done"], "o_totalprice")
    return r.withColumns({n: F.round(n, 6) for n in ("p10", "median", "p90")})


@query("SELECT o_custkey, o_orderkey AS plan FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderkey % 2 = 0 AND o_orderkey % 3 > 0) DESC, o_totalprice DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def best_plan(spark, d):
    from strideframe.operators import relational

    k = F.col("o_orderkey")
    o = table(spark, d, "orders").withColumn("pre", F.create_map(F.lit("collision_free"), k % 2 == 0, F.lit("coverage_complete"), k % 3 > 0))
    b = relational.best_row(o, ["o_custkey"], [F.forall(F.map_values("pre"), lambda x: x), F.col("o_totalprice"), k], ["o_orderkey"])
    return b.select("o_custkey", F.col("o_orderkey").alias("plan"))


@query("SELECT o_orderkey, o_totalprice, n, spent, segments FROM (SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 15 OFFSET 30), (SELECT count(*) AS n, round(sum(o_totalprice), 2) AS spent, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS segments FROM orders)")
def page_with_totals(spark, d):
    o = table(spark, d, "orders")
    totals = {"n": F.count(F.lit(1)), "spent": F.round(F.sum("o_totalprice"), 2), "segments": F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",")}
    return rollups.page_with_totals(o.select("o_orderkey", "o_totalprice", "o_orderpriority"), [F.col("o_totalprice"), F.col("o_orderkey")], 2, 15, totals).drop("o_orderpriority")


@query("SELECT c::DOUBLE AS clearance, w::DOUBLE AS corridor, n FROM (SELECT unnest([6, 30, 45]) AS c), (SELECT unnest([90, 120]) AS w), LATERAL (SELECT count(*) AS n FROM part WHERE p_size >= c AND p_retailprice >= 900 + w)")
def parameter_grid(spark, d):
    grid = rollups.parameter_grid(spark, clearance=[6.0, 30.0, 45.0], corridor=[90.0, 120.0])
    p = table(spark, d, "part")
    met = [F.count_if((F.col("p_size") >= c) & (F.col("p_retailprice") >= 900 + w)).alias(f"{int(c)}_{int(w)}") for c in (6.0, 30.0, 45.0) for w in (90.0, 120.0)]
    wide = p.agg(*met)
    long = wide.unpivot([], wide.columns, "combo", "n")
    return grid.withColumn("combo", F.concat_ws("_", F.col("clearance").cast("int"), F.col("corridor").cast("int"))).join(long, "combo").drop("combo")


_DIRECTIONS, _SPEEDS = {1: "forward", -90: "left", 179: "back", 90: "right"}, {100: "slow", 150: "medium", 200: "fast"}
_ACTION = "CASE event_id % 5 WHEN 0 THEN concat('move_strafe_100_', CAST(CASE WHEN event_id % 2 = 0 THEN -90 ELSE 7 END AS VARCHAR(9))) WHEN 1 THEN 'move_strafe_175_1' WHEN 2 THEN concat('camera_rotate_incremental_dp0.5_dy', CASE WHEN event_id % 2 = 0 THEN '-0.2' ELSE '0.05' END) WHEN 3 THEN 'camera_rotate_incremental_dp0_dy0.1' ELSE concat(event_type, '_x') END"


@query(f"""WITH a AS (SELECT user_id, {_ACTION} AS a FROM events), p AS (
SELECT user_id, 'move' AS kind, CASE regexp_extract(a, '_(-?[0-9]+)$', 1) WHEN '-90' THEN 'left' WHEN '1' THEN 'forward' ELSE regexp_extract(a, '_(-?[0-9]+)$', 1) || 'deg' END AS value FROM a WHERE a LIKE 'move_strafe%'
UNION ALL SELECT user_id, 'speed', CASE WHEN a LIKE 'move_strafe_100%' THEN 'slow' ELSE '175u/s' END FROM a WHERE a LIKE 'move_strafe%'
UNION ALL SELECT user_id, 'cam', CASE WHEN a LIKE '%dy-0.2' THEN 'up+left' WHEN a LIKE '%dp0.5%' THEN 'up' ELSE 'still' END FROM a WHERE a LIKE 'camera%'
UNION ALL SELECT user_id, 'other', split_part(a, '_', 1) FROM a WHERE a NOT LIKE 'camera%' AND a NOT LIKE 'move_strafe%') SELECT user_id, kind, value, count(*) AS n FROM p GROUP BY 1, 2, 3""")
def action_counts(spark, d):
    a = table(spark, d, "events").select("user_id", F.expr(_ACTION).alias("action"))
    return rollups.action_counts(a, "user_id", "action", _DIRECTIONS, _SPEEDS)


@query("SELECT o_orderkey, o_orderpriority, row_number() OVER (ORDER BY CASE WHEN o_custkey % 4 > 0 THEN o_totalprice END DESC NULLS LAST, o_orderkey) AS place FROM orders")
def nulls_last_order(spark, d):
    """Places of all rows in a global order, dealt over range partitions."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.when(F.col("o_custkey") % 4 > 0, F.col("o_totalprice")).alias("size"))
    placed = status.deal(o, [F.desc_nulls_last("size"), F.col("o_orderkey")], 1 << 62, "place")
    return placed.select("o_orderkey", "o_orderpriority", (F.col("place") + 1).alias("place"))


def clip_order(mode: str):
    """Order of a gallery: new (default), old, name or long; of equals the smaller slug."""
    order = {"old": [F.col("mtime")], "name": [F.col("slug")], "long": [F.desc("seconds")]}.get(mode, [F.desc("mtime")])
    return [*order, F.col("slug")]


@query("SELECT 'old' AS mode, o_orderkey AS slug, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS place FROM orders UNION ALL SELECT 'name', o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 FROM orders UNION ALL SELECT 'long', o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 FROM orders UNION ALL SELECT 'new', o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) - 1 FROM orders")
def selectable_sort(spark, d):
    clips = table(spark, d, "orders").select(F.col("o_orderkey").alias("slug"), F.col("o_orderdate").alias("mtime"), F.col("o_totalprice").alias("seconds"))
    out = None
    for mode in ("old", "name", "long", "new"):
        placed = status.deal(clips, clip_order(mode), 1 << 62, "place").select(F.lit(mode).alias("mode"), "slug", "place")
        out = placed if out is None else out.union(placed)
    return out


_SPREAD = """CASE how WHEN 'round' THEN list_transform(range(5), lambda i: round_even(i * (n - 1) / 4.0, 0)::BIGINT) WHEN 'truncate' THEN list_transform(range(5), lambda i: floor(i * (n - 1) / 4.0)::BIGINT)
WHEN 'capped' THEN list_transform(range(least(5, n)), lambda i: floor(i * (n - 1) / greatest(least(5, n) - 1, 1)::DOUBLE)::BIGINT) ELSE list_transform(range(5), lambda i: floor((i + 1) * n / 6.0)::BIGINT) END"""


@query(f"""WITH c AS (SELECT o_custkey, how, unnest(list_distinct({_SPREAD})) AS pos FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), (SELECT unnest(['round', 'truncate', 'inner', 'capped']) AS how)),
r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos FROM orders) SELECT o_custkey, how, pos, o_orderkey FROM c JOIN r USING (o_custkey, pos)""")
def evenly_spaced(spark, d):
    """Five rows of each customer by all four rounding rules."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    rows = rollups.spread_rows(o, "o_custkey", "o_orderkey", 5, ["round", "truncate", "inner", "capped"])
    return rows.select("o_custkey", "how", F.col("at").alias("pos"), "o_orderkey")


@query("SELECT o_custkey, o_orderkey, row_number() OVER (ORDER BY (o_orderstatus = 'F') DESC, o_totalprice DESC, o_orderkey) - 1 AS place FROM orders")
def queue_order(spark, d):
    """Finished before open, then the longest estimate first."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", (F.col("o_orderstatus") == "F").alias("finished"))
    return status.deal(o, [F.desc("finished"), F.desc("o_totalprice"), F.col("o_orderkey")], 1 << 62, "place").select("o_custkey", "o_orderkey", "place")


@query("""WITH p AS (SELECT c_custkey AS k, CASE c_custkey % 5 WHEN 0 THEN 'clearance45' WHEN 1 THEN 'lookup10' WHEN 2 THEN 'retry' WHEN 3 THEN 'drop' END AS category FROM customer), e AS (SELECT o_custkey AS k, max(o_totalprice) AS elapsed FROM orders WHERE o_orderkey % 3 > 0 GROUP BY 1)
SELECT p.k, category, coalesce(elapsed, 0) AS elapsed, (row_number() OVER (ORDER BY coalesce(elapsed, 0) DESC, p.k) - 1) % 9 AS worker FROM p LEFT JOIN e ON e.k = p.k WHERE category IN ('clearance45', 'lookup10', 'retry')""")
def second_pass(spark, d):
    """What is to be run again, slowest first, dealt over nine workers."""
    k = F.col("c_custkey")
    plan = table(spark, d, "customer").select(k.alias("k"), F.when(k % 5 == 0, "clearance45").when(k % 5 == 1, "lookup10").when(k % 5 == 2, "retry").when(k % 5 == 3, "drop").alias("category"))
    results = table(spark, d, "orders").where("o_orderkey % 3 > 0").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_totalprice").alias("elapsed"))
    return status.second_pass(plan, results, "k", ["clearance45", "lookup10", "retry"], 9).select("k", "category", "elapsed", "worker")


@query()
def seeded_draws(spark, d):
    """Seeded numpy draws per map; their stream has no SQL twin."""
    return graph.seeded_draws(table(spark, d, "part"), "p_partkey", "p_size", 3, 0.0, 1.0)


@query("SELECT p_partkey, p_size::DOUBLE AS fx, 0.0::DOUBLE AS worst, 1.0::DOUBLE AS norm FROM part")
def camera_identities(spark, d):
    """Scaled focal length, and that the quaternion of a rotation gives the matrix back: largest term difference 0, norm 1."""
    s = F.col("p_size").cast("double")
    b = G.basis(s, 7 * s, 3 * s)
    m = [[b[axis][i] for axis in ("forward", "right", "up")] for i in range(3)]
    p = table(spark, d, "part").withColumn("q", G.quaternion_from_matrix(m))
    back = G.matrix_from_quaternion(F.col("q"))
    worst = F.greatest(*[F.abs(F.get(back, 3 * i + j) - m[i][j]) for i in range(3) for j in range(3)])
    norm = F.sqrt(F.aggregate("q", F.lit(0.0), lambda a, x: a + x * x))
    return p.select("p_partkey", F.round(G.scale_intrinsics(s * 2, F.lit(1280.0), F.lit(640.0)), 6).alias("fx"), F.round(worst, 6).alias("worst"), F.round(norm, 6).alias("norm"))


@query("SELECT p_partkey, true AS pass FROM part")
def axis_smoke(spark, d):
    s = F.col("p_size").cast("double")
    return table(spark, d, "part").select("p_partkey", G.axis_smoke(F.lit(0.0), F.lit(0.0), F.lit(0.0), s, 7 * s, F.lit(0.0), F.lit(640.0), F.lit(640.0), F.lit(360.0)).alias("pass"))


@query("SELECT p_partkey, round(sqrt(pow(p_size * p_size, 2)) / 2, 6) AS area, greatest(least(p_retailprice, 1500), 1000) AS clamped, round(0.2126::DOUBLE * p_size + 0.7152::DOUBLE * 2 * p_size + 0.0722::DOUBLE * 3 * p_size, 6) AS luma, round(least(greatest(p_size / 50.0, 0), 1) ^ 2 * (3 - 2 * least(greatest(p_size / 50.0, 0), 1)), 6) AS eased FROM part")
def scalar_shapes(spark, d):
    s, z = F.col("p_size").cast("double"), F.lit(0.0)
    return table(spark, d, "part").select("p_partkey", F.round(G.triangle_area(z, z, z, s, z, z, z, s, z), 6).alias("area"), G.clamp(F.col("p_retailprice"), 1000.0, 1500.0).alias("clamped"), F.round(G.luma(s, 2 * s, 3 * s), 6).alias("luma"), F.round(G.smooth_step(s / 50), 6).alias("eased"))


@query("SELECT p_partkey, ceil(p_size / 7.0 - 1e-9)::BIGINT AS n, round(p_size - 7.0 * (ceil(p_size / 7.0 - 1e-9) - 1), 6) AS last, p_size::DOUBLE AS total FROM part")
def constant_profiles(spark, d):
    p = table(spark, d, "part").withColumn("w", graph.constant_profile(F.col("p_size").cast("double"), F.lit(7.0)))
    return p.select("p_partkey", F.size("w").cast("long").alias("n"), F.round(F.element_at("w", -1), 6).alias("last"), F.round(F.aggregate("w", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query("""WITH l AS (SELECT o_custkey AS k, o_orderkey AS leg, 5 + o_orderkey % 7 AS frames FROM orders), s AS (SELECT *, coalesce(sum(frames) OVER (PARTITION BY k ORDER BY leg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM l)
SELECT k, leg, (start + i)::BIGINT AS frame, CASE WHEN i = frames - 1 THEN leg::DOUBLE END AS arrived FROM (SELECT *, unnest(range(frames)) AS i FROM s)""")
def leg_timeline(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("leg"), (5 + F.col("o_orderkey") % 7).cast("int").alias("frames"), F.lit(2).alias("ramp"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.col("o_orderkey").cast("double").alias("x1"), F.lit(1.0).alias("y1"))
    t = graph.leg_timeline(o, "k").withColumn("last", F.max("frame").over(W.partitionBy("k", "leg")))
    return t.select("k", "leg", F.col("frame").cast("long").alias("frame"), F.when(F.col("frame") == F.col("last"), F.round("x", 6)).alias("arrived"))


@query(f"""WITH e AS (SELECT user_id, sec, value FROM {EV}), a AS (SELECT user_id, unnest([100000, 1500000]) + min(sec) OVER () AS at FROM (SELECT user_id, min(sec) AS sec FROM e GROUP BY 1)),
b AS (SELECT a.user_id, a.at, arg_max((e.sec, e.value), e.sec) AS lo FROM a JOIN e ON e.user_id = a.user_id AND e.sec <= a.at GROUP BY 1, 2), c AS (SELECT a.user_id, a.at, arg_min((e.sec, e.value), e.sec) AS hi FROM a JOIN e ON e.user_id = a.user_id AND e.sec > a.at GROUP BY 1, 2)
SELECT a.user_id, round(a.at, 3) AS at, round(CASE WHEN lo IS NULL THEN hi[2] WHEN hi IS NULL THEN lo[2] ELSE lo[2] + (hi[2] - lo[2]) * (a.at - lo[1]) / (hi[1] - lo[1]) END, 5) AS value FROM a LEFT JOIN b ON b.user_id = a.user_id AND b.at = a.at LEFT JOIN c ON c.user_id = a.user_id AND c.at = a.at""")
def interpolated(spark, d):
    e = _events(spark, d).select("user_id", "sec", "value")
    start = e.agg(F.min("sec").alias("t0"))
    first = e.groupBy("user_id").agg(F.min("sec").alias("s")).crossJoin(F.broadcast(start))  # one row
    asked = first.select("user_id", F.explode(F.array(F.lit(100000.0), F.lit(1500000.0))).alias("off"), "t0").select("user_id", (F.col("off") + F.col("t0")).alias("sec"))
    return S.interpolate(e, asked, "user_id", "sec", "value").select("user_id", F.round("sec", 3).alias("at"), F.round("value", 5).alias("value"))


@query("SELECT event_id, (event_id % 7)::DOUBLE AS lo, (event_id % 7 + 2)::DOUBLE AS hi, CASE event_id % 3 WHEN 0 THEN 'x' END AS missing FROM events")
def dict_literals(spark, d):
    text = F.format_string("limits {'lo': %d, 'hi': %d.0} end", F.col("event_id") % 7, F.col("event_id") % 7 + 2)
    t = table(spark, d, "events").withColumn("m", S.dict_literal(text))
    return t.select("event_id", F.col("m")["lo"].alias("lo"), F.col("m")["hi"].alias("hi"), F.when(F.try_element_at("m", F.lit("none")).isNull() & (F.col("event_id") % 3 == 0), "x").alias("missing"))


@query("SELECT page_id, split_part(split_part(url, '://', 2), '/', 2) AS section, lpad((page_id % 100)::VARCHAR, 6, '0') AS padded, sha256('{\"a\": ' || page_id || ', \"b\": \"' || split_part(split_part(url, '://', 2), '/', 2) || '\"}') AS digest FROM pages")
def path_and_digest(spark, d):
    part = S.path_segment(F.split_part("url", F.lit("://"), F.lit(2)), 1)
    p = table(spark, d, "pages").select("page_id", part.alias("section"), F.lpad((F.col("page_id") % 100).cast("string"), 6, "0").alias("padded"))
    return p.withColumn("digest", F.sha2(S.canonical_json({"b": F.col("section"), "a": F.col("page_id")}), 256))


@query("SELECT event_id, coalesce(json_extract_string(props, '$.k')::BIGINT, 0) AS k, coalesce(json_extract_string(props, '$.none'), 'unknown') AS other FROM events")
def json_defaults(spark, d):
    return table(spark, d, "events").select("event_id", S.json_get(F.col("props"), "$.k", F.lit(0), "long").alias("k"), S.json_get(F.col("props"), "$.none", F.lit("unknown")).alias("other"))


@query("SELECT user_id, sum(n)::BIGINT AS n, event_type AS label FROM (SELECT user_id, event_type, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY 1, 2 UNION ALL SELECT user_id, event_type, count(*) FROM events WHERE event_id % 2 = 1 GROUP BY 1, 2) GROUP BY 1, 3")
def counter_merge(spark, d):
    e = table(spark, d, "events")
    per = lambda r: e.where(F.col("event_id") % 2 == r).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n")).groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias(f"m{r}"))
    both = per(0).join(per(1), "user_id", "full").select("user_id", F.explode(S.merge_counts(F.col("m0"), F.col("m1"))).alias("label", "n"))
    return both.select("user_id", "n", "label")


@query("SELECT p_partkey, CASE p_brand WHEN 'Brand#2' THEN 'two' WHEN 'Brand#17' THEN 'seventeen' ELSE 'other' END AS label FROM part")
def label_lookup(spark, d):
    return table(spark, d, "part").select("p_partkey", S.lookup(F.col("p_brand"), {"Brand#2": "two", "Brand#17": "seventeen"}, "other").alias("label"))


@query("SELECT l_orderkey, l_linenumber, round(abs(l_quantity - 25) / 5, 6) AS violation FROM lineitem WHERE abs(l_quantity - 25) > 5")
def violation_scores(spark, d):
    v = S.violation(F.col("l_quantity"), 20.0, 30.0)
    l = table(spark, d, "lineitem").withColumn("off", v).where("off > 0")
    return l.select("l_orderkey", "l_linenumber", F.round(F.col("off") / 5 + 1, 6).alias("violation"))


@query("SELECT user_id, least(count(*) FILTER (event_type = 'error' AND event_id < 500), 1) AS seen, least(least(count(*) FILTER (event_type = 'error' AND event_id < 500), 2) + count(*) FILTER (event_type = 'error' AND event_id >= 500), 2) AS handled, CASE WHEN count(*) FILTER (event_type = 'error' AND event_id >= 500) = 0 THEN 'none' WHEN count(*) FILTER (event_type = 'error' AND event_id < 500) < 2 THEN 'requeue' ELSE 'give_up' END AS action FROM events GROUP BY 1 HAVING count(*) FILTER (event_type = 'error') > 0")
def requeue_counter(spark, d):
    e = table(spark, d, "events").where("event_type = 'error'")
    empty = e.limit(0).select("user_id", F.lit(0).cast("long").alias("handled"))
    first = leases.requeue_state(empty, e.where("event_id < 500"), "user_id")
    second = leases.requeue_state(first, e.where("event_id >= 500"), "user_id")
    return second.join(first.select("user_id", F.least("handled", F.lit(1)).alias("seen")), "user_id", "left").select("user_id", F.coalesce("seen", F.lit(0)).cast("long").alias("seen"), "handled", "action")


@query(f"SELECT event_id FROM {EV} WHERE sec > 1704500000")
def current_run(spark, d):
    return leases.of_this_run(_events(spark, d), "sec", F.lit(1704500000.0)).select("event_id")


@query("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def latest_state(spark, d):
    e = table(spark, d, "events").select("user_id", "ts", "event_id", "value")
    old = leases.latest_upsert(e.limit(0), e.where("event_id % 2 = 0"), "user_id", "ts")
    return leases.latest_upsert(old, e.where("event_id % 2 = 1"), "user_id", "ts").select("user_id", "event_id", "value")


@query("SELECT event_id FROM events WHERE epoch(TIMESTAMP '2024-01-20 00:00:00') - floor(epoch(ts)) >= 120")
def settled_files(spark, d):
    e = table(spark, d, "events").withColumn("modified", F.col("ts").cast("timestamp"))
    return listing.settled(e, F.lit("2024-01-20 00:00:00").cast("timestamp"), 120).select("event_id")


@query("SELECT p.doc_id AS episode_id, p.path, CASE WHEN l.quality IS NULL THEN '_unjudged' WHEN l.quality = 1 THEN 'accepted' ELSE '_rejected' END AS verdict FROM (SELECT doc_id, lang || '/' || source || (CASE doc_id % 3 WHEN 0 THEN '/rgb.mp4' ELSE '/frames.csv' END) AS path, n_chars FROM documents) p LEFT JOIN labels l USING (doc_id) WHERE p.path NOT LIKE '%.mp4' AND doc_id % 4 > 0")
def uploads_by_verdict(spark, d):
    f = table(spark, d, "documents").select(F.col("doc_id").alias("episode_id"), F.concat("lang", F.lit("/"), "source", F.when(F.col("doc_id") % 3 == 0, "/rgb.mp4").otherwise("/frames.csv")).alias("path"), (F.col("n_chars") * 1000000 + F.col("doc_id")).alias("length"))
    episodes = f.select("episode_id").join(table(spark, d, "labels").select(F.col("doc_id").alias("episode_id"), (F.col("quality") == 1).alias("accepted")), "episode_id", "left")
    sent = f.where("episode_id % 4 = 0").select("path", "length")
    return listing.to_upload(f, episodes, sent, [], ["*.mp4", "*/rgb_keyframes/*"]).select("episode_id", "path", "verdict")


@query("SELECT source AS prefix, count(*) AS files, sum(n_chars)::BIGINT AS bytes FROM documents GROUP BY 1")
def listed_prefixes(spark, d):
    f = table(spark, d, "documents").select(F.concat(F.lit("s3://bucket/root/"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("path"), F.col("n_chars").alias("length"))
    return listing.prefixes(f, "s3://bucket/root", 1)


@query("SELECT o_custkey AS log, count(*) FILTER (o_orderkey % 5 = 1) AS n_failures, count(*) FILTER (o_orderkey % 5 = 2) > 0 AND count(*) FILTER (o_orderkey % 5 = 3) > 0 AS proven, coalesce(string_agg(DISTINCT 'Maps/M' || (o_orderkey % 9), ',' ORDER BY 'Maps/M' || (o_orderkey % 9)) FILTER (o_orderkey % 5 = 1), '') AS failures FROM orders GROUP BY 1")
def failed_materials(spark, d):
    k = F.col("o_orderkey")
    text = F.when(k % 5 == 1, F.concat(F.lit("x: Failed to compile Material /Content/Maps/M"), (k % 9).cast("string"), F.lit(".uasset now"))).when(k % 5 == 2, "LogInit: ok").when(k % 5 == 3, "LogShaderCompilers: done").otherwise("other")
    lines = table(spark, d, "orders").select(F.col("o_custkey").alias("log"), text.alias("value"))
    return documents.failed_materials(lines, "log").select("log", "n_failures", "proven", F.array_join("failures", ",").alias("failures"))


@query("SELECT n_nationkey, 'Fab_' || n_nationkey AS key, n_name AS title, 'P' || n_regionkey AS project FROM nation WHERE n_nationkey % 3 > 0")
def index_entries(spark, d):
    k = F.col("n_nationkey").cast("string")
    link = F.when(F.col("n_nationkey") % 3 > 0, F.concat(F.lit("entry: [Projects/P"), F.col("n_regionkey").cast("string"), F.lit("/Main](x)"))).otherwise("none")
    section = F.concat(F.lit("## Fab_"), k, F.lit(" · "), F.col("n_name"), F.lit("\ntext\n"), link, F.lit("\n"))
    texts = table(spark, d, "nation").select(section.alias("value")).agg(F.concat(F.lit("# index\n"), F.array_join(F.collect_list("value"), "")).alias("value"))
    return documents.index_entries(texts).select(F.split_part("key", F.lit("_"), F.lit(2)).cast("int").alias("n_nationkey"), "key", "title", "project")


@query("SELECT n_nationkey, 'clip' AS mode, (n_nationkey * 2)::VARCHAR AS speed, 'a: b' AS note FROM nation")
def dual_metadata(spark, d):
    n = F.col("n_nationkey")
    text = documents.read_metadata(F.concat(F.lit("mode: run\nspeed: "), (n * 2).cast("string"), F.lit("\nnote: a: b\nspeed: 9\nno colon here")))
    clip = documents.read_metadata(F.lit('{"mode": "clip"}'))
    m = table(spark, d, "nation").withColumn("m", documents.overlay(text, clip))
    return m.select("n_nationkey", F.col("m")["mode"].alias("mode"), F.col("m")["speed"].alias("speed"), F.col("m")["note"].alias("note"))


def _nested(spark, d):
    inner = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("cust"))
    return table(spark, d, "orders").select("o_orderkey", F.struct(inner.alias("who"), F.col("o_orderpriority").alias("priority")).alias("doc"))


@query("SELECT o_orderkey, label, value FROM (SELECT o_orderkey, unnest(['who.status', 'who.cust', 'priority']) AS label, unnest([o_orderstatus, o_custkey::VARCHAR, o_orderpriority]) AS value FROM orders)")
def nested_to_rows(spark, d):
    return S.flatten(_nested(spark, d), "o_orderkey", "doc")


@query("SELECT o_orderkey, o_orderstatus AS status, 1 AS fields FROM orders")
def dropped_field(spark, d):
    """A struct without one of its fields."""
    n = _nested(spark, d).withColumn("who", F.col("doc.who").dropFields("cust"))
    return n.select("o_orderkey", "who.status", F.size(F.json_object_keys(F.to_json("who"))).alias("fields"))


@query("SELECT p_partkey, regexp_replace(p_type, '^ECO', '') AS stripped, lower(replace(p_name, ' ', '_')) AS slug FROM part")
def slugs(spark, d):
    return table(spark, d, "part").select("p_partkey", F.regexp_replace("p_type", "^ECO", "").alias("stripped"), F.lower(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("slug"))
