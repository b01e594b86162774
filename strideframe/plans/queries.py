"""Registered queries: each applies one of the engine's operators to a driver table.

The driver tables stand in for telemetry: an episode is a user or a customer, frame order is event
time, a manifest is ``orders``, results are ``lineitem``. ORACLE holds the SQL twin of each query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strideframe.functions import geometry as G
from strideframe.operators import gates, relational, reports, rollups, scans, sequence, spatial, status
from strideframe.session import ensure_checkpoints, table
from strideframe.streaming import claims, leases

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _epoch(c: str = "ts"):
    return F.unix_micros(F.col(c).cast("timestamp")) / 1e6


def _events(spark, d):
    return table(spark, d, "events").withColumn("sec", _epoch())


EV = "(SELECT *, epoch_us(ts) / 1e6 AS sec FROM events)"


@query(f"""
WITH l AS (SELECT user_id, event_type, sec, coalesce(value - lag(value) OVER w, 0) AS step, coalesce(sec - lag(sec) OVER w, 0) AS dt FROM {EV} WINDOW w AS (PARTITION BY user_id ORDER BY sec, event_id)),
a AS (SELECT user_id, count(*) AS n, max(abs(step)) AS max_step, quantile_cont(CASE WHEN dt > 0 THEN abs(step / dt) ELSE 0 END, 0.95) AS p95_rate, count(DISTINCT event_type) AS kinds, max(dt) AS max_gap FROM l GROUP BY user_id)
SELECT user_id, gate, result FROM (
 SELECT user_id, 'enough_rows' AS gate, CASE WHEN n >= 20 THEN 'pass' ELSE 'FAIL' END AS result FROM a
 UNION ALL SELECT user_id, 'step_bounded', CASE WHEN max_step < 300 THEN 'pass' ELSE 'FAIL' END FROM a
 UNION ALL SELECT user_id, 'rate_within_tier', CASE WHEN p95_rate <= 1.25 THEN 'pass' ELSE 'FAIL' END FROM a
 UNION ALL SELECT user_id, 'all_kinds_present', CASE WHEN kinds >= 5 THEN 'pass' ELSE 'warn' END FROM a
 UNION ALL SELECT user_id, 'gap_bounded', CASE WHEN n < 4 THEN 'skip' WHEN max_gap < 864000 THEN 'pass' ELSE 'FAIL' END FROM a)""")
def gate_report(spark, d):
    rows = sequence.lag_metrics(_events(spark, d), "user_id", ["sec", "event_id"], "value", F.col("sec"))
    wide = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.abs("step")).alias("max_step"), F.percentile(F.abs("rate"), 0.95).alias("p95_rate"), F.count_distinct("event_type").alias("kinds"), F.max("dt").alias("max_gap"))
    c = F.col
    rules = [
        gates.Gate("enough_rows", c("n") >= 20, c("n").cast("string")), gates.Gate("step_bounded", c("max_step") < 300, c("max_step").cast("string")),
        gates.Gate("rate_within_tier", c("p95_rate") <= 1.25, c("p95_rate").cast("string")), gates.Gate("all_kinds_present", c("kinds") >= 5, c("kinds").cast("string"), advisory=True),
        gates.Gate("gap_bounded", c("max_gap") < 864000, c("max_gap").cast("string"), c("n") >= 4),
    ]
    return gates.judge(wide, "user_id", rules).drop("detail")


@query(f"""WITH g AS ({ORACLE['gate_report']}) SELECT user_id, count(*) AS total, count(*) FILTER (result = 'FAIL') AS failed, count(*) FILTER (result = 'skip') AS skipped, count(*) FILTER (result IN ('pass', 'warn')) AS passed FROM g GROUP BY user_id""")
def gate_rollup(spark, d):
    return gates.verdicts(gate_report(spark, d).withColumn("detail", F.lit("")), "user_id").select("user_id", "total", "failed", "skipped", "passed")


@query("SELECT event_id, abs(((value * 7 - 90 + 540) % 360 + 360) % 360 - 180) AS diff FROM events")
def wrapped_angle(spark, d):
    return table(spark, d, "events").select("event_id", G.wrapped_diff(F.col("value") * 7, F.lit(90)).alias("diff"))


@query("SELECT p_partkey, round(p_size * 10 / (2 * tan(radians(60) / 2)), 6) AS fx, round(cos(radians(p_size)) * cos(radians(2 * p_size)), 6) AS fwd_x FROM part")
def pose_scalars(spark, d):
    s = F.col("p_size").cast("double")
    return table(spark, d, "part").select("p_partkey", F.round(G.focal_px(s * 10, F.lit(60.0)), 6).alias("fx"), F.round(G.basis(s, 2 * s, F.lit(0.0))["forward"][0], 6).alias("fwd_x"))


@query("SELECT p_partkey, CASE WHEN p_retailprice >= 1500 THEN 'big' WHEN p_retailprice >= 1100 THEN 'mid' ELSE 'small' END AS tier FROM part")
def size_tiers(spark, d):
    p = F.col("p_retailprice")
    return table(spark, d, "part").select("p_partkey", F.when(p >= 1500, "big").when(p >= 1100, "mid").otherwise("small").alias("tier"))


@query("SELECT doc_id, sha256(text) AS digest FROM documents")
def sha256_texts(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))


@query("SELECT page_id, regexp_extract(url, '/([a-z][a-z])/', 1) AS section, regexp_extract(url, '([0-9]+)', 1) AS number FROM pages")
def regex_extract(spark, d):
    return table(spark, d, "pages").select("page_id", F.regexp_extract("url", "/([a-z][a-z])/", 1).alias("section"), F.regexp_extract("url", "([0-9]+)", 1).alias("number"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderpriority LIKE '1%' THEN 'urgent' WHEN o_totalprice > 200000 THEN 'large' ELSE 'queued' END AS state FROM orders")
def rule_precedence(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderpriority").startswith("1"), "urgent").when(F.col("o_totalprice") > 200000, "large").otherwise("queued").alias("state"))


@query(f"""WITH x AS (SELECT user_id, sec, CASE WHEN sec - lag(sec) OVER w > 43200 THEN 1 ELSE 0 END AS f FROM {EV} WINDOW w AS (PARTITION BY user_id ORDER BY sec)),
y AS (SELECT user_id, sec, sum(f) OVER (PARTITION BY user_id ORDER BY sec ROWS UNBOUNDED PRECEDING) AS island FROM x)
SELECT user_id, CAST(island AS BIGINT) AS island, count(*) AS n, min(sec) AS first, max(sec) AS last FROM y GROUP BY 1, 2""")
def gaps_and_islands(spark, d):
    return sequence.islands(_events(spark, d), "user_id", "sec", 43200)


@query("""WITH x AS (SELECT DISTINCT l_partkey AS k, l_suppkey AS i FROM lineitem), r AS (SELECT k, i, i - row_number() OVER (PARTITION BY k ORDER BY i) AS g FROM x), s AS (SELECT k, g, count(*) AS n, min(i) AS first FROM r GROUP BY 1, 2)
SELECT k, n AS run_length, first AS run_start FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, first) AS rn FROM s) WHERE rn = 1""")
def longest_run(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_partkey").alias("k"), F.col("l_suppkey").alias("i"))
    return sequence.longest_run(rows, "k", "i")


@query("""WITH x AS (SELECT DISTINCT l_orderkey AS k, l_linenumber - 1 AS i FROM lineitem), r AS (SELECT k, i, row_number() OVER (PARTITION BY k ORDER BY i) - 1 AS p FROM x)
SELECT k, coalesce(min(CASE WHEN i <> p THEN p END), count(*)) AS prefix FROM r GROUP BY k""")
def torn_prefix(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_linenumber") - 1).alias("i"))
    return sequence.contiguous_prefix(rows, "k", "i")


@query(f"""WITH p AS (SELECT user_id, event_id, sec / 1000 AS x, value AS y, lag(sec / 1000) OVER w AS px, lag(value) OVER w AS py FROM {EV} WINDOW w AS (PARTITION BY user_id ORDER BY sec, event_id))
SELECT event_id, round(sum(coalesce(sqrt(pow(x - px, 2) + pow(y - py, 2)), 0)) OVER (PARTITION BY user_id ORDER BY x, event_id ROWS UNBOUNDED PRECEDING), 3) AS arc FROM p""")
def arc_length(spark, d):
    rows = _events(spark, d).withColumn("x", F.col("sec") / 1000)
    return sequence.arc_length(rows, "user_id", ["x", "event_id"], "x", "value").select("event_id", F.round("arc", 3).alias("arc"))


@query(f"SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY sec, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 6) AS smoothed FROM {EV}")
def moving_average(spark, d):
    return sequence.moving_average(_events(spark, d), "user_id", ["sec", "event_id"], "value", 3).select("event_id", F.round("smoothed", 6).alias("smoothed"))


@query(f"WITH g AS (SELECT user_id, sec - lag(sec) OVER (PARTITION BY user_id ORDER BY sec, event_id) AS gap FROM {EV}) SELECT user_id, max(gap) AS max_gap, CASE WHEN count(gap) >= 4 THEN median(gap) END AS median_gap FROM g GROUP BY user_id")
def event_gaps(spark, d):
    w = W.partitionBy("user_id").orderBy("sec", "event_id")
    g = _events(spark, d).withColumn("gap", F.col("sec") - F.lag("sec").over(w))
    return g.groupBy("user_id").agg(F.max("gap").alias("max_gap"), F.when(F.count("gap") >= 4, F.median("gap")).alias("median_gap"))


@query("SELECT l_orderkey, l_linenumber, round(l_quantity - next, 6) AS delta FROM (SELECT *, lead(l_quantity) OVER w AS next, lead(l_linenumber) OVER w AS nl FROM (SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2) WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)) WHERE nl = l_linenumber + 1")
def adjacent_rows(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"))  # line numbers repeat
    p = sequence.adjacent_pairs(lines, "l_orderkey", "l_linenumber", "l_quantity")
    return p.select("l_orderkey", "l_linenumber", F.round(F.col("l_quantity") - F.col("next_value"), 6).alias("delta"))


@query("""SELECT o_orderkey, coalesce(l.n, 0) AS n_done, CASE WHEN l.n IS NULL THEN 'queued' WHEN l.returned > 0 THEN 'failed' ELSE 'done' END AS state FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS returned FROM lineitem GROUP BY 1) l ON o_orderkey = l_orderkey""")
def manifest_status(spark, d):
    done = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("returned"))
    j = table(spark, d, "orders").join(done, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return j.select("o_orderkey", F.coalesce("n", F.lit(0)).alias("n_done"), F.when(F.col("n").isNull(), "queued").when(F.col("returned") > 0, "failed").otherwise("done").alias("state"))


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'N')")
def unfinished(spark, d):
    done = table(spark, d, "lineitem").where("l_returnflag = 'N'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").join(done, "o_orderkey", "left_anti").select("o_orderkey")


@query("""WITH a AS (SELECT o_custkey AS k, max(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey AS k, max(o_totalprice) AS v FROM orders GROUP BY 1)
SELECT c_custkey AS k, coalesce(a.v, b.v, c_acctbal) AS size, CASE WHEN a.v IS NOT NULL THEN 'queue' WHEN b.v IS NOT NULL THEN 'survey' ELSE 'offline' END AS size_source FROM customer LEFT JOIN a ON a.k = c_custkey LEFT JOIN b ON b.k = c_custkey""")
def priority_coalesce(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_acctbal")
    per = lambda x: x.groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_totalprice").alias("v"))
    out = relational.coalesce_sources(c, "k", [("queue", per(o.where("o_orderstatus = 'F'")), "v"), ("survey", per(o), "v"), ("offline", c, "c_acctbal")], "size")
    return out.select("k", "size", "size_source")


@query("SELECT n_name, w FROM (SELECT n_name, unnest(string_split(lower(n_name), 'a')) AS w FROM nation) WHERE w <> ''")
def exploded_levels(spark, d):
    return table(spark, d, "nation").select("n_name", F.explode(F.split(F.lower("n_name"), "a")).alias("w")).where("w <> ''")


@query("SELECT DISTINCT c_custkey FROM customer JOIN orders ON o_custkey = c_custkey JOIN events ON user_id = c_custkey")
def presence3(spark, d):
    c, o, e = table(spark, d, "customer"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), table(spark, d, "events").select(F.col("user_id").alias("c_custkey"))
    return c.select("c_custkey").join(o, "c_custkey", "left_semi").join(e, "c_custkey", "left_semi").distinct()


@query("SELECT d.doc_id, CASE WHEN l.quality IS NULL THEN 'carried' WHEN l.quality = 0 THEN 'FAIL' ELSE 'pass' END AS result, l.doc_id IS NOT NULL AS judged FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def carry_over(spark, d):
    j = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").withColumn("judged", F.lit(True)), "doc_id", "left")
    return j.select("doc_id", F.when(F.col("quality").isNull(), "carried").when(F.col("quality") == 0, "FAIL").otherwise("pass").alias("result"), F.coalesce("judged", F.lit(False)).alias("judged"))


@query("SELECT coalesce(c_nationkey, s_nationkey) AS nation, c IS NOT NULL AS has_customer, s IS NOT NULL AS has_supplier FROM (SELECT c_nationkey, count(*) AS c FROM customer GROUP BY 1) FULL JOIN (SELECT s_nationkey, count(*) AS s FROM supplier GROUP BY 1) ON c_nationkey = s_nationkey")
def presence_flags(spark, d):
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("c"))
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("s"))
    return c.join(s, "nation", "full").select("nation", F.col("c").isNotNull().alias("has_customer"), F.col("s").isNotNull().alias("has_supplier"))


@query("SELECT DISTINCT least(l_partkey, l_suppkey) AS u, greatest(l_partkey, l_suppkey) AS v FROM lineitem")
def undirected_keys(spark, d):
    return table(spark, d, "lineitem").select(*relational.undirected("l_partkey", "l_suppkey")).distinct()


@query("SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.1), 6) AS p10, round(median(l_extendedprice), 6) AS p50, round(quantile_cont(l_extendedprice, 0.9), 6) AS p90, round(quantile_cont(l_extendedprice, 0.99), 6) AS p99, max(l_extendedprice) AS most, round(avg(l_extendedprice), 4) AS mean FROM lineitem GROUP BY 1")
def percentiles(spark, d):
    ensure_checkpoints(spark)
    shares = {"p10": 0.1, "p50": 0.5, "p90": 0.9, "p99": 0.99}
    r = rollups.percentile_table(table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice", shares)
    return r.select("l_returnflag", *[F.round(n, 6).alias(n) for n in shares], "most", F.round("mean", 4).alias("mean"))


@query("SELECT o_custkey, o_totalprice AS upper_median FROM (SELECT o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice) AS r, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE r = n // 2 + 1")
def upper_median(spark, d):
    ensure_checkpoints(spark)
    return rollups.upper_median(table(spark, d, "orders"), "o_custkey", "o_totalprice")


@query("""WITH h AS (SELECT l_returnflag, CAST(floor(l_quantity) AS BIGINT) AS bin, count(*) AS n FROM lineitem GROUP BY 1, 2), c AS (SELECT *, sum(n) OVER (PARTITION BY l_returnflag ORDER BY bin) AS cum, sum(n) OVER (PARTITION BY l_returnflag) AS total FROM h)
SELECT l_returnflag, min(bin) FILTER (cum >= 0.5 * total) AS p50, min(bin) FILTER (cum >= 0.99 * total) AS p99 FROM c GROUP BY 1""")
def histogram_quantile(spark, d):
    h = table(spark, d, "lineitem").groupBy("l_returnflag", F.floor("l_quantity").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy("l_returnflag")
    c = h.withColumns({"cum": F.sum("n").over(w.orderBy("bin")), "total": F.sum("n").over(w)})
    q = lambda x: F.min(F.when(F.col("cum") >= x * F.col("total"), F.col("bin")))
    return c.groupBy("l_returnflag").agg(q(0.5).alias("p50"), q(0.99).alias("p99"))


@query("SELECT user_id, event_type, count(*) / sum(count(*)) OVER (PARTITION BY user_id) AS share FROM events GROUP BY 1, 2")
def phase_shares(spark, d):
    g = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return g.select("user_id", "event_type", (F.col("n") / F.sum("n").over(W.partitionBy("user_id"))).alias("share"))


@query(f"WITH s AS ({ORACLE['phase_shares']}) SELECT user_id, event_type, share BETWEEN 0.1 - 0.01 AND 0.3 + 0.01 AS in_band, greatest(0.1 - share, share - 0.3, 0) AS off_by FROM s")
def band_check(spark, d):
    s = F.col("share")
    return phase_shares(spark, d).select("user_id", "event_type", s.between(0.1 - 0.01, 0.3 + 0.01).alias("in_band"), F.greatest(0.1 - s, s - 0.3, F.lit(0.0)).alias("off_by"))


@query("SELECT u.user_id, t.event_type FROM (SELECT DISTINCT user_id FROM events) u, (SELECT DISTINCT event_type FROM events) t WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = u.user_id AND e.event_type = t.event_type AND e.value > 95)")
def missing_labels(spark, d):
    return rollups.missing_labels(table(spark, d, "events"), "user_id", "event_type", F.col("value") > 95)


@query("SELECT o_custkey, o_orderkey AS best, o_totalprice AS price FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'F' DESC, o_totalprice DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def best_row(spark, d):
    o = table(spark, d, "orders")
    b = relational.best_row(o, ["o_custkey"], [F.col("o_orderstatus") == "F", F.col("o_totalprice"), F.col("o_orderkey")], ["o_orderkey", "o_totalprice"])
    return b.select("o_custkey", F.col("o_orderkey").alias("best"), F.col("o_totalprice").alias("price"))


@query("SELECT kind, value, count(*) AS n FROM (SELECT 'lang' AS kind, lang AS value FROM documents UNION ALL SELECT 'source', source FROM documents) GROUP BY 1, 2")
def multi_counter(spark, d):
    return table(spark, d, "documents").selectExpr("stack(2, 'lang', lang, 'source', source) AS (kind, value)").groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT r_name, n_name, count(*) AS n, count(*) FILTER (c_acctbal < 0) AS negative, sum(c_acctbal) AS total FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)")
def rollup_packs(spark, d):
    j = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.rollup("r_name", "n_name").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("c_acctbal") < 0).alias("negative"), F.sum("c_acctbal").alias("total"))


@query("SELECT event_id FROM events WHERE event_id % 12 = 0 OR event_id IN (SELECT max(event_id) FROM events GROUP BY user_id)")
def stride_sample(spark, d):
    e = table(spark, d, "events")
    last = e.groupBy("user_id").agg(F.max("event_id").alias("event_id")).select("event_id")
    return e.where("event_id % 12 = 0").select("event_id").union(last).distinct()


@query("SELECT s_suppkey, (row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) - 1) % 10 AS worker FROM supplier")
def round_robin(spark, d):
    ensure_checkpoints(spark)
    return status.deal(table(spark, d, "supplier"), [F.desc("s_acctbal"), F.col("s_suppkey")], 10).select("s_suppkey", F.col("worker").cast("long").alias("worker"))


@query("SELECT p_brand, p_partkey, rank FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part) WHERE rank <= 3")
def top_per_group(spark, d):
    return table(spark, d, "part").select("p_brand", "p_partkey", F.row_number().over(W.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey")).cast("long").alias("rank")).where("rank <= 3")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 10")
def page_of_rows(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(10).limit(20)


@query("""WITH p AS (SELECT l_suppkey AS k, l_orderkey * 8 + l_linenumber AS frame, l_quantity AS x, l_discount * 100 AS y, l_partkey % 360 AS yaw FROM lineitem),
m AS (SELECT a.k, a.frame AS probe, b.frame AS f, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) AS dist FROM p a JOIN p b ON a.k = b.k AND a.frame - b.frame >= 240 WHERE abs(((a.yaw - b.yaw + 540) % 360 + 360) % 360 - 180) <= 10)
SELECT k, probe, round(min(dist), 6) AS dist FROM m WHERE dist <= 1.5 GROUP BY 1, 2""")
def same_pose_pairs(spark, d):
    c = F.col
    p = table(spark, d, "lineitem").select(c("l_suppkey").alias("k"), (c("l_orderkey") * 8 + c("l_linenumber")).alias("frame"), c("l_quantity").alias("x"), (c("l_discount") * 100).alias("y"), (c("l_partkey") % 360).cast("double").alias("yaw"))
    return spatial.same_pose(p, "k", "frame", 240, 1.5, 10.0).select("k", "probe", F.round("dist", 6).alias("dist"))


@query("SELECT user_id, min(sec) AS claimed_at, arg_min(event_id, (sec, event_id)) AS owner FROM " + EV + " GROUP BY user_id")
def first_claim(spark, d):
    return relational.first_claim(_events(spark, d), "user_id", "event_id", ["sec", "event_id"])


@query(f"""WITH l AS (SELECT user_id, max(sec) AS heartbeat_epoch FROM {EV} GROUP BY 1) SELECT user_id, CASE WHEN 1706600000 - heartbeat_epoch < 86400 THEN 'live' ELSE 'expired' END AS state FROM l""")
def lease_state(spark, d):
    l = _events(spark, d).groupBy("user_id").agg(F.max("sec").alias("heartbeat_epoch"))
    return l.select("user_id", relational.lease_state(l, F.lit(1706600000.0), 86400).alias("state"))


@query(f"""WITH x AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS f FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), y AS (SELECT user_id, ts, sum(f) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM x)
SELECT user_id, epoch_us(min(ts)) // 1000000 AS start_s, epoch_us(max(ts)) // 1000000 + 21600 AS end_s, count(*) AS beats FROM y GROUP BY user_id, s""")
def lease_sessions(spark, d):
    s = leases.lease_sessions(table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "ts", "6 hours")
    return s.select("user_id", F.unix_seconds("start").alias("start_s"), F.unix_seconds("end").alias("end_s"), "beats")


@query(f"WITH x AS (SELECT event_id, user_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY sec, event_id) AS diff FROM {EV}) SELECT event_id, abs(diff - median(diff) OVER (PARTITION BY user_id)) AS drift FROM x WHERE diff IS NOT NULL")
def drift(spark, d):
    w = W.partitionBy("user_id")
    x = _events(spark, d).withColumn("diff", F.col("value") - F.lag("value").over(w.orderBy("sec", "event_id"))).where("diff IS NOT NULL")
    return x.select("event_id", F.abs(F.col("diff") - F.median("diff").over(w)).alias("drift"))


@query("SELECT bool_and(isfinite(value)) AS finite, count(*) = count(DISTINCT event_id) AS unique_ids, count(*) AS n FROM events")
def sequence_integrity(spark, d):
    return table(spark, d, "events").agg(F.bool_and(~F.isnan("value") & (F.abs("value") < float("inf"))).alias("finite"), (F.count(F.lit(1)) == F.count_distinct("event_id")).alias("unique_ids"), F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderpriority, CASE WHEN count(*) >= 3 THEN avg(o_totalprice) * 100 / 3600 END AS eta, CAST(floor((max(o_orderkey) + 100) / 100) * 100 AS BIGINT) AS next_seed, round_even(avg(o_totalprice) / 1000, 0) AS passes FROM orders GROUP BY 1")
def budget(spark, d):
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(F.when(F.count(F.lit(1)) >= 3, F.avg("o_totalprice") * 100 / 3600).alias("eta"), (F.floor((F.max("o_orderkey") + 100) / 100) * 100).alias("next_seed"), F.bround(F.avg("o_totalprice") / 1000, 0).alias("passes"))


@query("SELECT l_shipdate_month AS m, n, CASE WHEN base <> 0 THEN 100.0 * (n - base) / base END AS change FROM (SELECT month(l_shipdate) AS l_shipdate_month, count(*) AS n, first_value(count(*)) OVER (ORDER BY month(l_shipdate)) AS base FROM lineitem GROUP BY 1)")
def change_vs_baseline(spark, d):
    g = table(spark, d, "lineitem").groupBy(F.month("l_shipdate").alias("m")).agg(F.count(F.lit(1)).alias("n"))  # 12 rows
    return g.withColumn("base", F.first("n").over(W.orderBy("m"))).select("m", "n", F.try_divide(100.0 * (F.col("n") - F.col("base")), F.nullif("base", F.lit(0))).alias("change"))


@query("SELECT count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars, source FROM documents GROUP BY GROUPING SETS ((source), ())")
def size_rollup(spark, d):
    return table(spark, d, "documents").rollup("source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query("SELECT event_id, json_extract_string(props, '$.' || k) AS v, k FROM events, (SELECT unnest(json_keys(props)) AS k, event_id AS i FROM events) WHERE event_id = i")
def json_flatten(spark, d):
    e = table(spark, d, "events").select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("k", "v"))
    return e.select("event_id", "k", "v")


@query("""WITH RECURSIVE e AS (SELECT DISTINCT l_partkey AS u, l_suppkey + 10000000 AS v FROM lineitem), b AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
r(id, near) AS (SELECT DISTINCT u, u FROM b UNION SELECT r.id, b.v FROM r JOIN b ON b.u = r.near) SELECT id, min(near) AS component FROM r GROUP BY id""")
def components(spark, d):
    """Part-supplier links of all rows; stands for triangles that share an edge."""
    ensure_checkpoints(spark)
    e = table(spark, d, "lineitem").select(F.col("l_partkey").alias("u"), (F.col("l_suppkey") + 10_000_000).alias("v"))
    return relational.connected_components(e)


_STEPS = f"e AS (SELECT user_id, sec, value, row_number() OVER (PARTITION BY user_id ORDER BY sec, event_id) AS i FROM {EV})"


@query(f"WITH RECURSIVE {_STEPS}, r AS (SELECT user_id, i, sec, value, value AS limited FROM e WHERE i = 1 UNION ALL SELECT e.user_id, e.i, e.sec, e.value, least(greatest(e.value, r.limited - 5), r.limited + 5) FROM r JOIN e ON e.user_id = r.user_id AND e.i = r.i + 1) SELECT user_id, sec, value, round(limited, 6) AS limited FROM r")
def slew_limited(spark, d):
    ensure_checkpoints(spark)
    return scans.slew_limited(_events(spark, d), "user_id", "sec", "value", 5.0).withColumn("limited", F.round("limited", 6))


@query(f"WITH RECURSIVE {_STEPS}, r AS (SELECT user_id, i, sec, value, value AS last, true AS kept FROM e WHERE i = 1 UNION ALL SELECT e.user_id, e.i, e.sec, e.value, CASE WHEN abs(e.value - r.last) >= 20 THEN e.value ELSE r.last END, abs(e.value - r.last) >= 20 FROM r JOIN e ON e.user_id = r.user_id AND e.i = r.i + 1) SELECT user_id, sec, value FROM r WHERE kept")
def spaced_waypoints(spark, d):
    ensure_checkpoints(spark)
    return scans.spaced_waypoints(_events(spark, d), "user_id", "sec", "value", 20.0)


@query(f"""
WITH m AS (SELECT user_id, event_type, sec, event_id, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new FROM {EV} WINDOW w AS (PARTITION BY user_id ORDER BY sec, event_id)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY sec, event_id) AS run FROM m)
SELECT user_id, event_type, min(sec) AS since, max(sec) AS until, count(*) AS n FROM r GROUP BY user_id, event_type, run HAVING max(sec) - min(sec) >= 3600""")
def stalls(spark, d):
    return reports.stalls(_events(spark, d), "user_id", ["sec", "event_id"], "event_type", "sec", 3600.0)


@query(f"""
SELECT event_id, user_id FROM (SELECT *, coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY sec, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM {EV}) WHERE b < 3""")
def trim_at_nth(spark, d):
    return reports.trim_at_nth(_events(spark, d), "user_id", ["sec", "event_id"], F.col("event_type") == "purchase", 3).select("event_id", "user_id")


@query("""
SELECT user_id, event_id AS chosen, value <= 5 AS passed FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN value <= 5 THEN 0 ELSE 1 END, CASE WHEN value <= 5 THEN event_id END, value, event_id) AS rn FROM events) WHERE rn = 1""")
def first_passing(spark, d):
    return reports.first_passing(table(spark, d, "events"), "user_id", "event_id", "value", 5.0)


@query("""
WITH e AS (SELECT user_id, event_id, abs(value - 50) AS err FROM events), r AS (SELECT *, sum(CASE WHEN err > 20 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM e)
SELECT user_id, max(err) AS worst, count(*) FILTER (err > 20) AS n_over, coalesce(string_agg(event_id::VARCHAR, ',' ORDER BY event_id) FILTER (err > 20 AND k <= 12), '') AS offenders FROM r GROUP BY user_id""")
def offenders(spark, d):
    return reports.offenders(table(spark, d, "events"), "user_id", "event_id", F.abs(F.col("value") - 50), 20.0)


@query(f"""
WITH s AS ({ORACLE['phase_shares']}), b AS (SELECT user_id, event_type, greatest(0.1::DOUBLE - share, share - 0.3::DOUBLE, 0::DOUBLE) AS d FROM s)
SELECT user_id, round(sum(d * d), 9) AS distance, (SELECT c.event_type FROM b c WHERE c.user_id = b.user_id ORDER BY round(c.d, 9) DESC, c.event_type DESC LIMIT 1) AS worst FROM b GROUP BY user_id""")
def band_distance(spark, d):
    return reports.band_distance(phase_shares(spark, d), "user_id", "event_type", "share", 0.1, 0.3)


@query("""
SELECT o_custkey, count(*) AS handled, CASE WHEN count(*) < 2 THEN 'requeue' ELSE 'give_up' END AS action, ((max(o_orderkey) + 100) // 100 * 100)::BIGINT AS next_seed FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey""")
def requeue(spark, d):
    return reports.requeue(table(spark, d, "orders").where("o_orderstatus = 'F'"), "o_custkey", "o_orderkey")


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM lineitem s WHERE s.l_returnflag = 'N' AND s.l_orderkey = l.l_orderkey AND s.l_linenumber = l.l_linenumber AND s.l_extendedprice = l.l_extendedprice)""")
def unseen_files(spark, d):
    files = table(spark, d, "lineitem")
    name = ["l_orderkey", "l_linenumber", "l_extendedprice"]
    return reports.unseen(files.select(*name), files.where("l_returnflag = 'N'"), name)


@query(f"""
SELECT event_id, user_id FROM {EV} s WHERE event_type <> 'purchase' AND NOT EXISTS (SELECT 1 FROM {EV} h WHERE h.event_type = 'purchase' AND h.user_id = s.user_id AND h.sec >= s.sec AND h.sec <= s.sec + 86400)""")
def spans_without_hits(spark, d):
    e = _events(spark, d)
    spans = e.where("event_type <> 'purchase'").select("event_id", "user_id", "sec", (F.col("sec") + 86400).alias("stop"))
    return reports.spans_without_hits(spans, e.where("event_type = 'purchase'"), "user_id", "sec", "stop", "sec").select("event_id", "user_id")


@query("SELECT vec_id, count(*) FILTER (abs(x) < 0.1) / count(*) AS near_share, count(*) FILTER (abs(x) < 0.1) / count(*) > 0.2 AS buried FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY vec_id")
def near_share(spark, d):
    return reports.near_share(table(spark, d, "embeddings"), "embedding", 0.1).select("vec_id", "near_share", "buried")


@query(f"WITH g AS ({ORACLE['gate_report']}) SELECT user_id, coalesce(string_agg(gate, ',' ORDER BY gate) FILTER (upper(result) LIKE 'FAIL%'), '') AS failed FROM g GROUP BY user_id")
def failed_gates(spark, d):
    listed = gate_report(spark, d).groupBy("user_id").agg(F.collect_list(F.struct("gate", "result")).alias("gates"))
    failed = F.transform(F.filter("gates", lambda g: F.upper(g["result"]).like("FAIL%")), lambda g: g["gate"])
    return listed.select("user_id", F.array_join(F.sort_array(failed), ",").alias("failed"))


@query("""WITH RECURSIVE e AS (SELECT user_id % 50 AS slug, event_type AS worker, epoch_us(ts) // 1000 AS "at", event_id AS n, row_number() OVER (PARTITION BY user_id % 50 ORDER BY epoch_us(ts) // 1000, event_id) AS i FROM events),
r AS (SELECT slug, worker, "at", n, i, 'claimed' AS verdict, worker AS owner, "at" AS beat FROM e WHERE i = 1 UNION ALL SELECT e.slug, e.worker, e."at", e.n, e.i,
CASE WHEN e."at" - r.beat >= 21600000 THEN CASE WHEN e.worker = r.owner THEN 'claimed' ELSE 'taken over' END WHEN e.worker = r.owner THEN 'beat' ELSE 'refused' END,
CASE WHEN e."at" - r.beat >= 21600000 THEN e.worker ELSE r.owner END, CASE WHEN e."at" - r.beat >= 21600000 OR e.worker = r.owner THEN e."at" ELSE r.beat END FROM r JOIN e ON e.slug = r.slug AND e.i = r.i + 1)
SELECT slug::VARCHAR AS slug, worker, "at", n, verdict, owner FROM r""")
def claim_takeovers(spark, d):
    """Claims, beats, refusals and takeovers in order of time, leases of six hours."""
    e = table(spark, d, "events").select((F.col("user_id") % 50).cast("string").alias("slug"), F.col("event_type").alias("worker"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").cast("long").alias("n"))
    return claims.claims_table(e, 6 * 3600)
