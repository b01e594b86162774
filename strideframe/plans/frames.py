"""Registered queries over a frame table: the events of a user stand in for the frames of an episode.

EXPR holds what the stand-in states consist of; both engines read the same text.
"""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strideframe.operators import classify, frames, gates, rollups, sequence
from strideframe.plans.queries import _events, query
from strideframe.session import table

EXPR = {
    "x": "value * 3", "y": "CAST(event_id % 97 AS DOUBLE)", "z": "CAST(event_id % 13 AS DOUBLE)",
    "pitch": "CAST(event_id % 11 - 5 AS DOUBLE)", "yaw": "CAST(event_id * 37 % 360 AS DOUBLE)", "roll": "CAST(event_id % 3 - 1 AS DOUBLE)",
    "off": "CAST(event_id % 5 AS DOUBLE) / 10", "yaw_off": "CAST(event_id % 4 AS DOUBLE) / 8",
    "phase": "CASE WHEN event_id % 16 < 7 THEN 'forward' WHEN event_id % 16 < 10 THEN 'backward' WHEN event_id % 16 = 10 THEN 'turn_left' WHEN event_id % 16 = 11 THEN 'turn_right' WHEN event_id % 16 = 12 THEN 'look_up' WHEN event_id % 16 = 13 THEN 'look_down' ELSE 'hold' END",
    "valid": "CASE WHEN event_id % 50 = 0 THEN CAST(0 AS DOUBLE) ELSE value / 100 END", "near": "value / 10 - CASE WHEN user_id % 9 = 0 THEN 1 ELSE 0 END", "far": "value * 5", "centre": "value",
}
FPS = 24
_S = ", ".join(f"{v} AS {k}" for k, v in EXPR.items())
_WRAP = "abs((({0}) % 360 + 360) % 360 - 180)"
FRAMES = f"""s AS (SELECT user_id AS episode_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_id, {_S} FROM events),
p AS (SELECT *, coalesce(lag(x) OVER w, x) AS px, coalesce(lag(y) OVER w, y) AS py, coalesce(lag(z) OVER w, z) AS pz, coalesce(lag(yaw) OVER w, yaw) AS pyaw FROM s WINDOW w AS (PARTITION BY episode_id ORDER BY frame_id)),
f AS (SELECT *, frame_id / {FPS}::DOUBLE AS episode_time_s, off AS pos_error_cm, {_WRAP.format('-yaw_off + 540')} AS yaw_error_deg, sqrt((x - px) * (x - px) + (y - py) * (y - py) + (z - pz) * (z - pz)) AS step_cm, {_WRAP.format('yaw - pyaw + 540')} * {FPS} AS yaw_rate_deg_s FROM p),
g AS (SELECT *, step_cm / 100 * {FPS} AS speed_m_s FROM f)"""


def states(spark, d):
    e = table(spark, d, "events")
    n = F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    flat = e.select("user_id", n.cast("long").alias("frame_id"), *[F.expr(v).alias(k) for k, v in EXPR.items()])
    here, turned = F.array("x", "y", "z"), F.array("pitch", "yaw", "roll")
    depth = F.struct(F.col("valid").alias("valid_fraction"), F.col("near").alias("min_m"), F.col("far").alias("max_m"), F.col("centre").alias("centre_m"), F.lit(16).alias("bit_depth"))
    return flat.select(
        F.col("user_id").alias("episode_id"), "frame_id", "phase", F.array(F.col("x") + F.col("off"), "y", "z").alias("desired_location"), here.alias("actual_location"),
        F.array("pitch", F.col("yaw") + F.col("yaw_off"), "roll").alias("desired_rotation_pyr"), turned.alias("actual_rotation_pyr"), F.array(*[F.lit(float(i == 3)) for i in range(4)]).alias("quat_xyzw"), depth.alias("depth"),
    )


def frame_table(spark, d):
    return frames.build_frames(states(spark, d), FPS)


@query(f"""WITH {FRAMES} SELECT episode_id, frame_id, phase, round(episode_time_s, 9) AS t, round(pos_error_cm, 6) AS pos_error_cm, round(yaw_error_deg, 6) AS yaw_error_deg, round(step_cm, 6) AS step_cm, round(speed_m_s, 6) AS speed_m_s, round(yaw_rate_deg_s, 6) AS yaw_rate_deg_s,
round(cos(radians(pitch)) * cos(radians(yaw)), 6) + 0.0::DOUBLE AS forward_x, round(x / 100, 6) AS place_x, 'rgb/' || lpad(frame_id::VARCHAR, 6, '0') || '.jpg' AS rgb_path FROM g""")
def frame_rows(spark, d):
    r = lambda c: F.round(c, 6).alias(c)
    cell = lambda i: F.split_part("c2w", F.lit(" "), F.lit(i)).cast("double") + F.lit(0.0)
    return frame_table(spark, d).select("episode_id", "frame_id", "phase", F.round("episode_time_s", 9).alias("t"), *[r(c) for c in ("pos_error_cm", "yaw_error_deg", "step_cm", "speed_m_s", "yaw_rate_deg_s")], cell(3).alias("forward_x"), cell(4).alias("place_x"), "rgb_path")


@query(f"""WITH {FRAMES} SELECT episode_id, count(*) AS frames, round(avg(pos_error_cm) + 1e-9, 6) AS pos_error_mean, round(max(pos_error_cm), 6) AS pos_error_max, round(avg(yaw_error_deg) + 1e-9, 6) AS yaw_error_mean, round(max(yaw_error_deg), 6) AS yaw_error_max, round(max(speed_m_s), 6) AS speed_max, round(max(yaw_rate_deg_s), 6) AS yaw_rate_max FROM g GROUP BY 1""")
def frame_summary(spark, d):
    s = frames.frame_summary(frame_table(spark, d))
    # the means get a trace more, as a tie of the last digit falls either way with the order of a sum
    return s.select("episode_id", "frames", *[F.round(F.col(c) + (1e-9 if c.endswith("mean") else 0.0), 6).alias(c) for c in s.columns[2:]])


_MOTION = f"""{FRAMES}, m AS (SELECT episode_id, frame_id, sqrt(pow(nx - x, 2) + pow(ny - y, 2) + pow(nz - z, 2)) AS moved_cm, greatest({_WRAP.format('pitch - np + 540')}, {_WRAP.format('yaw - nyaw + 540')}, {_WRAP.format('roll - nr + 540')}) AS turned_deg
FROM (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny, lead(z) OVER w AS nz, lead(pitch) OVER w AS np, lead(yaw) OVER w AS nyaw, lead(roll) OVER w AS nr FROM g WINDOW w AS (PARTITION BY episode_id ORDER BY frame_id)) WHERE nx IS NOT NULL)"""


@query(f"WITH {_MOTION} SELECT episode_id, frame_id, CASE WHEN turned_deg > 0.05 THEN 'turn' WHEN moved_cm > 0.5 THEN 'moving' ELSE 'static' END AS kind, moved_cm > 0.5 OR turned_deg > 0.05 AS moving, moved_cm < 0.01 AND turned_deg < 0.01 AS still FROM m")
def pair_kinds(spark, d):
    m = frames.frame_motion(frame_table(spark, d))
    return m.select("episode_id", "frame_id", frames.motion_class().alias("kind"), frames.pair_kind(True).alias("moving"), frames.pair_kind(False).alias("still"))


_COARSE = f"""{FRAMES}, c AS (SELECT episode_id, frame_id, floor(x / 100) AS moved FROM g), m AS (SELECT episode_id, frame_id FROM (SELECT *, lead(moved) OVER (PARTITION BY episode_id ORDER BY frame_id) AS after FROM c) WHERE after = moved)"""


@query(f"WITH {_COARSE} SELECT a.episode_id, a.frame_id FROM m a JOIN m b ON a.episode_id = b.episode_id AND b.frame_id = a.frame_id + 1")
def static_runs(spark, d):
    """The pose is the 100 cm cell here: real stand-in frames never rest."""
    f = frame_table(spark, d).select("episode_id", "frame_id", F.floor(F.col("actual_x_cm") / 100).cast("double").alias("actual_x_cm"), *[F.lit(0.0).alias(c) for c in ("actual_y_cm", "actual_z_cm", "actual_pitch_deg", "actual_yaw_deg", "actual_roll_deg")])
    return frames.static_runs(frames.frame_motion(f))


@query(f"""WITH {FRAMES}, w AS (SELECT *, lead(frame_id) OVER v AS nf, lead(x) OVER v AS nx, lead(y) OVER v AS ny FROM g WHERE phase IN ('forward', 'backward') WINDOW v AS (PARTITION BY episode_id ORDER BY frame_id))
SELECT episode_id, frame_id, round(sqrt(pow(nx - x, 2) + pow(ny - y, 2)) / 100 * {FPS}, 6) AS planar_m_s FROM w WHERE nf = frame_id + 1""")
def planar_speed(spark, d):
    return frames.planar_speed(frame_table(spark, d), FPS).select("episode_id", "frame_id", F.round("planar_m_s", 6).alias("planar_m_s"))


@query(f"WITH {FRAMES} SELECT episode_id, frame_id, round(off, 6) AS actual_x_cm, round(yaw_off, 6) AS actual_yaw_deg FROM g")
def replay_diff(spark, d):
    """A replay that stands where the plan asked: its difference is the pose error."""
    f = frame_table(spark, d)
    replay = f.select("episode_id", "frame_id", F.col("desired_x_cm").alias("actual_x_cm"), F.col("desired_yaw_deg").alias("actual_yaw_deg"))
    r = frames.replay_diff(f, replay, ["actual_x_cm", "actual_yaw_deg"])
    return r.select("episode_id", "frame_id", F.round("actual_x_cm", 6).alias("actual_x_cm"), F.round("actual_yaw_deg", 6).alias("actual_yaw_deg"))


#: the record of an episode, by its number u; n is its frame count
LIMIT_EXPR = {
    "frozen_frames": "n + CASE WHEN u % 7 = 0 THEN 1 ELSE 0 END", "ended_early_reason": "CASE WHEN u % 14 = 0 THEN 'killed' END", "jpegs": "n - CASE WHEN u % 11 = 0 THEN 1 ELSE 0 END",
    "decoded": "n", "unreadable": "CASE WHEN u % 13 = 0 THEN 1 ELSE 0 END", "blank": "CASE WHEN u % 5 = 0 THEN 1 ELSE 0 END", "duplicate_pairs": "CASE WHEN u % 17 = 0 THEN 2 ELSE 0 END",
    "width": "CASE WHEN u % 19 = 0 THEN 640 ELSE 1280 END", "k_width": "1280", "height": "720", "k_height": "720", "log_proven": "u % 3 <> 0", "material_failures": "CASE WHEN u % 4 = 0 THEN 3 ELSE 0 END", "axis_pass": "u % 23 <> 0",
    "reach_available": "CASE WHEN u % 6 = 0 THEN NULL ELSE u % 6 <> 1 END", "reachable": "u % 10 <> 2", "collision_free": "u % 12 <> 0", "max_translation_cm": "CAST(u % 60 AS DOUBLE)", "yaw_deg_per_s": "CASE WHEN u % 2 = 0 THEN CAST(5000 AS DOUBLE) END",
    "family": "CASE WHEN u % 2 = 0 THEN 'coverage_walk' ELSE 'out_and_back' END", "revisit_applicable": "u % 2 = 1", "anchor_end": "u % 5", "requested_age_s": "CAST(u AS DOUBLE)", "realised_age_s": "u + CAST(u % 4 AS DOUBLE)",
    "revisit_kind": "CASE WHEN u % 3 = 0 THEN 'exact' WHEN u % 3 = 1 THEN 'near' ELSE 'partial' END", "translation_error_cm": "CAST(u % 90 AS DOUBLE)", "rotation_error_deg": "CAST(u % 13 AS DOUBLE)", "matches": "CASE WHEN u % 4 <> 1 THEN u END",
    "speed_tier": "CASE WHEN u % 3 = 0 THEN 'slow' WHEN u % 3 = 1 THEN 'medium' ELSE 'fast' END", "speed_pinned": "u % 4 = 0", "pin_m_s": "CAST(30 AS DOUBLE)", "pitch_limit_deg": "CAST(4 + u % 2 AS DOUBLE)", "roll_limit_deg": "CAST(u % 4 AS DOUBLE)",
    "depth_missing": "CASE WHEN u % 15 = 0 THEN 1 ELSE 0 END", "penetrating_frames": "CASE WHEN u % 8 <> 1 THEN CASE WHEN u % 8 = 2 THEN 4 ELSE 0 END END", "coverage_fraction": "CASE WHEN u % 6 = 0 THEN 0.9 ELSE 1.0 END",
}
_L = ", ".join(f"{v} AS {k}" for k, v in LIMIT_EXPR.items())
_PCT = "quantile_cont({0}, {1})"
_ACTIONS = ("forward", "backward", "turn_left", "turn_right", "look_up", "look_down")
_RULES = [
    ("frame_count_matches_frozen", "ended_early_reason IS NOT NULL OR n = frozen_frames", None, None), ("time_base_exact", "time_error < 1e-9", None, None), ("all_frames_present", "jpegs = n", None, None), ("frames_decode", "unreadable = 0", None, None),
    ("resolution_matches_K", "width = k_width AND height = k_height", None, None), ("no_blank_frames", "blank <= floor(0.005 * decoded)", None, None), ("no_duplicate_frames", "duplicate_pairs = 0", None, None), ("materials_compiled", "material_failures = 0", "log_proven", None),
    ("axis_semantics", "axis_pass", None, None), ("pose_tracking", "max_pos < 2 AND max_yaw_error < 0.5", None, None), ("route_reachable", "reachable", "reach_available", "reach_available IS NOT NULL"), ("collision_free", "collision_free", None, None),
    ("frame_translation_bounded", "max_translation_cm < 50", None, None), ("frame_rotation_bounded", "max_rate <= 1.5 * coalesce(yaw_deg_per_s, 60)", None, None), ("revisit_age_matches_request", "abs(realised_age_s - requested_age_s) <= greatest(0.5, 0.05 * requested_age_s)", "revisit_applicable", None),
    ("memory_anchor_is_not_first_frame", "anchor_end > 0", "revisit_applicable", None), ("revisit_pose_closure", "translation_error_cm <= CASE revisit_kind WHEN 'exact' THEN 2 WHEN 'near' THEN 100 ELSE 400 END AND rotation_error_deg <= CASE revisit_kind WHEN 'exact' THEN 1 WHEN 'near' THEN 10 ELSE 45 END", "revisit_applicable", None),
    ("speed_within_tier", "p95_speed <= 1.25 * CASE speed_tier WHEN 'slow' THEN 0.6 WHEN 'medium' THEN 1.0 ELSE 1.5 END", None, None), ("speed_pinned_held", "abs(walk_median - pin_m_s) <= 0.02 * pin_m_s AND walk_p95 <= 1.02 * pin_m_s", None, "speed_pinned AND pin_m_s > 0"),
    ("attitude_within_limits", "max_pitch <= pitch_limit_deg + 0.5 AND max_roll <= roll_limit_deg + 0.5", None, None), ("revisit_view_overlap_proxy", "matches >= 50", "revisit_applicable AND matches IS NOT NULL", None), ("metric_depth_present", "depth_missing = 0", None, None),
    ("depth_not_empty", "dead <= floor(0.005 * n)", None, None), ("depth_range_plausible", "min_depth > 0.05 AND max_depth < 1000", None, None), ("no_geometry_penetration", "penetrating_frames = 0", "penetrating_frames IS NOT NULL", None),
    ("depth_visible_overlap", "true", "false", None), ("fully_occluded_interval", "true", "false", None), ("instance_semantic_masks", "true", "false", None), ("road_coverage_complete", "coverage_fraction = 1.0", None, "family = 'coverage_walk'"),
    ("action_mix_in_band", "n_forward / n BETWEEN 0.29 AND 0.51 AND n_hold / n BETWEEN -0.01 AND 0.21", None, "family = 'coverage_walk'"), ("all_six_actions_present", "least(" + ", ".join(f"n_{a}" for a in _ACTIONS) + ") > 0", None, "family = 'coverage_walk'"),
]
_ROWS = " UNION ALL ".join(f"SELECT episode_id, '{g}' AS gate, CASE WHEN NOT coalesce({a or 'true'}, false) OR ({p}) IS NULL THEN 'skip' WHEN {p} THEN 'pass' ELSE '{'warn' if g == 'action_mix_in_band' else 'FAIL'}' END AS result FROM w WHERE {x or 'true'}" for g, p, a, x in _RULES)
ACCEPTANCE = f"""WITH {FRAMES}, q AS (SELECT *, CASE WHEN phase IN ('forward', 'backward') AND lead(phase) OVER v IN ('forward', 'backward') THEN sqrt(pow(lead(x) OVER v - x, 2) + pow(lead(y) OVER v - y, 2)) / 100 * {FPS} END AS planar FROM g WINDOW v AS (PARTITION BY episode_id ORDER BY frame_id)),
a AS (SELECT episode_id, episode_id AS u, count(*) AS n, max(abs(episode_time_s - frame_id / {FPS}::DOUBLE)) AS time_error, max(pos_error_cm) AS max_pos, max(yaw_error_deg) AS max_yaw_error, max(yaw_rate_deg_s) AS max_rate, {_PCT.format('speed_m_s', 0.95)} AS p95_speed,
 coalesce({_PCT.format('planar', 0.5)}, {_PCT.format("CASE WHEN phase IN ('forward', 'backward') THEN speed_m_s END", 0.5)}, {_PCT.format('speed_m_s', 0.5)}) AS walk_median, coalesce({_PCT.format('planar', 0.95)}, {_PCT.format("CASE WHEN phase IN ('forward', 'backward') THEN speed_m_s END", 0.95)}, {_PCT.format('speed_m_s', 0.95)}) AS walk_p95,
 max(abs(pitch)) AS max_pitch, max(abs(roll)) AS max_roll, count(*) FILTER (valid <= 0.001) AS dead, min(near) AS min_depth, max(far) AS max_depth, {', '.join(f"count(*) FILTER (phase = '{x}') AS n_{x}" for x in (*_ACTIONS, 'hold'))} FROM q GROUP BY 1),
w AS (SELECT *, {_L} FROM a) {_ROWS}"""


def limits(spark, d):
    """One LIMITS row per episode."""
    counts = table(spark, d, "events").groupBy(F.col("user_id").alias("u")).agg(F.count(F.lit(1)).alias("n"))
    kinds = dict(part.split() for part in gates.LIMITS.split("revisit_events")[0].rstrip(", ").split(", "))
    cast = lambda k, v: F.expr(v).cast(kinds.get(k, "double")).alias(k)
    band = F.create_map(F.lit("forward"), F.array(F.lit(0.3), F.lit(0.5)), F.lit("hold"), F.array(F.lit(0.0), F.lit(0.2)))
    none = F.lit(None).cast("array<struct<requested_age_s double, realised_age_s double, translation_error_cm double, rotation_error_deg double>>")
    return counts.select(F.col("u").alias("episode_id"), F.lit(float(FPS)).alias("fps"), *[cast(k, v) for k, v in LIMIT_EXPR.items()], none.alias("revisit_events"), band.alias("mix_target"))


@query(ACCEPTANCE)
def acceptance(spark, d):
    return gates.acceptance(frame_table(spark, d), limits(spark, d)).drop("detail")


@query(f"WITH r AS ({ACCEPTANCE}) SELECT episode_id, count(*) AS total, count(*) FILTER (result = 'FAIL') AS failed, count(*) FILTER (result = 'skip') AS skipped, count(*) FILTER (result IN ('pass', 'warn')) AS passed, coalesce(string_agg(gate, ',' ORDER BY gate) FILTER (result = 'FAIL'), '') AS failed_gates FROM r GROUP BY 1")
def acceptance_rollup(spark, d):
    v = gates.verdicts(acceptance(spark, d), "episode_id")
    return v.select("episode_id", "total", "failed", "skipped", "passed", F.array_join("failed_gates", ",").alias("failed_gates"))


@query(f"""WITH r AS ({ACCEPTANCE}), o AS (SELECT episode_id, gate, result AS old_result FROM r WHERE gate <> 'axis_semantics'), n AS (SELECT episode_id, gate, CASE result WHEN 'FAIL' THEN 'pass' ELSE result END AS new_result FROM r WHERE gate IN ('pose_tracking', 'axis_semantics', 'collision_free', 'speed_within_tier'))
SELECT episode_id, gate, CASE WHEN (gate IN ('pose_tracking', 'collision_free') AND new_result IS NOT NULL) OR old_result IS NULL THEN new_result ELSE old_result END AS result, CASE WHEN (gate IN ('pose_tracking', 'collision_free') AND new_result IS NOT NULL) OR old_result IS NULL THEN 'new' ELSE 'carried' END AS origin FROM o FULL JOIN n USING (episode_id, gate)""")
def carried_verdicts(spark, d):
    r = acceptance(spark, d)
    new = r.where(F.col("gate").isin("pose_tracking", "axis_semantics", "collision_free", "speed_within_tier")).withColumn("result", F.when(F.col("result") == "FAIL", "pass").otherwise(F.col("result")))
    return gates.carry_verdicts(r.where("gate <> 'axis_semantics'"), new, "episode_id", ["pose_tracking", "collision_free"])


_PLAN = {"max_translation_cm": "CAST(o_orderkey % 60 AS DOUBLE)", "max_yaw_rate": "CAST(o_orderkey % 90 AS DOUBLE)", "yaw_limit": "CAST(60 AS DOUBLE)", "max_pitch": "CAST(o_orderkey % 21 AS DOUBLE)", "pitch_limit_deg": "CAST(18 AS DOUBLE)", "collision_free": "o_orderkey % 10 <> 0", "probe_clear": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 9 <> 0 END", "coverage_fraction": "CAST(o_orderkey % 3 AS DOUBLE)", "mix_in_band": "o_orderkey % 5 <> 0", "retrace_requested": "o_orderkey % 2 = 0", "cadence_ok": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderkey % 8 <> 0 END"}
_PRE = {"frame_translation_bounded": "max_translation_cm < 50", "frame_rotation_bounded": "max_yaw_rate <= yaw_limit", "attitude_within_limits": "max_pitch <= pitch_limit_deg + 0.5", "collision_free": "collision_free", "depth_probe_clear": "probe_clear", "coverage_complete": "coverage_fraction >= 1", "action_mix_in_band": "mix_in_band", "retrace_cadence_ok": "NOT retrace_requested OR coalesce(cadence_ok, true)"}


def _plans(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("plan_id"), "o_orderkey", *[F.expr(v).alias(k) for k, v in _PLAN.items()])


@query(f"WITH p AS (SELECT o_orderkey AS plan_id, {', '.join(f'{v} AS {k}' for k, v in _PLAN.items())} FROM orders) " + " UNION ALL ".join(f"SELECT plan_id, '{k}' AS gate, coalesce({v}, false) AS ok FROM p" for k, v in _PRE.items()))
def pre_gates(spark, d):
    return gates.pre_gates(_plans(spark, d))


@query(f"WITH p AS (SELECT o_orderkey AS plan_id, o_totalprice, o_orderkey, {', '.join(f'{v} AS {k}' for k, v in _PLAN.items())} FROM orders) SELECT plan_id, CASE WHEN NOT collision_free THEN 'refused_collision' WHEN NOT coalesce(probe_clear, false) THEN 'refused_depth_probe' WHEN o_totalprice / 500000 < 0.75 THEN 'refused_disconnected_network' WHEN coverage_fraction < 1 THEN 'refused_partial_cover' END AS refusal, CASE WHEN NOT collision_free THEN CASE WHEN o_orderkey % 7 > 0 THEN (o_orderkey % 7)::VARCHAR || ' sweeps hit' END WHEN NOT coalesce(probe_clear, false) THEN CASE WHEN o_orderkey % 3 > 0 THEN (o_orderkey % 3)::VARCHAR || ' clamped at the near plane' ELSE 'no named reason' END END AS reason FROM p")
def plan_refusals(spark, d):
    p = table(spark, d, "orders").select(F.col("o_orderkey").alias("plan_id"), *[F.expr(v).alias(k) for k, v in _PLAN.items()], (F.col("o_totalprice") / 500000).alias("kept_fraction"), (F.col("o_orderkey") % 7).alias("collision_count"), (F.col("o_orderkey") % 3).alias("clamped"), F.lit(None).cast("long").alias("sky"), F.lit(0).alias("thin"))
    return p.select("plan_id", classify.refusal().alias("refusal"), classify.refusal_reason().alias("reason"))


@query(f"WITH {FRAMES}, h AS (SELECT *, (frame_id % 5 = 0) AS contact FROM g) SELECT episode_id, frame_id FROM (SELECT *, lag(x > 150) OVER (PARTITION BY episode_id ORDER BY frame_id) AS before FROM h) WHERE x > 150 AND NOT coalesce(before, false)")
def contact_entries(spark, d):
    f = frame_table(spark, d).withColumn("contact", F.col("actual_x_cm") > 150)
    return sequence.entries(f, "episode_id", ["frame_id"], "contact").select("episode_id", "frame_id")


@query(f"WITH {FRAMES} SELECT episode_id, frame_id, round(abs(centre - lag(centre) OVER (PARTITION BY episode_id ORDER BY frame_id)), 6) AS jump FROM g")
def brightness_jumps(spark, d):
    return sequence.jumps(frame_table(spark, d), "episode_id", ["frame_id"], "depth_centre_m").select("episode_id", "frame_id", F.round("jump", 6).alias("jump"))


@query(f"""WITH {FRAMES}, h AS (SELECT episode_id, frame_id, coalesce(lead(x) OVER w, x) - coalesce(lag(x) OVER w, x) AS dx, coalesce(lead(y) OVER w, y) - coalesce(lag(y) OVER w, y) AS dy FROM g WINDOW w AS (PARTITION BY episode_id ORDER BY frame_id))
SELECT episode_id, frame_id, round(coalesce(last_value(CASE WHEN dx <> 0 OR dy <> 0 THEN degrees(atan2(dy, dx)) END IGNORE NULLS) OVER (PARTITION BY episode_id ORDER BY frame_id ROWS UNBOUNDED PRECEDING), 0), 6) AS heading FROM h""")
def headings(spark, d):
    return sequence.heading(frame_table(spark, d), "episode_id", ["frame_id"], "actual_x_cm", "actual_y_cm").select("episode_id", "frame_id", F.round("heading", 6).alias("heading"))


_CAP = """c AS (SELECT *, sqrt(pow(ax - x, 2) + pow(ay - y, 2)) * sqrt(pow(x - cx, 2) + pow(y - cy, 2)) * sqrt(pow(ax - cx, 2) + pow(ay - cy, 2)) AS sides, abs((x - ax) * (cy - ay) - (cx - ax) * (y - ay)) / 2 AS area FROM (SELECT *, lag(x) OVER w AS ax, lag(y) OVER w AS ay, lead(x) OVER w AS cx, lead(y) OVER w AS cy FROM g WINDOW w AS (PARTITION BY episode_id ORDER BY frame_id))),
v AS (SELECT episode_id, frame_id, x, y, greatest(least(100::DOUBLE, coalesce(CASE WHEN area >= 1e-6 AND sides >= 1e-6 THEN sqrt(120 * sides / (4 * area)) END, 100)), 20) AS cap FROM c)"""


@query(f"WITH {FRAMES}, {_CAP} SELECT episode_id, frame_id, round(cap, 5) AS cap FROM v")
def curvature_cap(spark, d):
    return sequence.curvature_cap(frame_table(spark, d), "episode_id", ["frame_id"], "actual_x_cm", "actual_y_cm", 100.0, 120.0, 20.0).select("episode_id", "frame_id", F.round("cap", 5).alias("cap"))


@query(f"""WITH RECURSIVE {FRAMES}, {_CAP}, e AS (SELECT *, coalesce(sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2)), 0) AS step, count(*) OVER (PARTITION BY episode_id) AS n FROM v WINDOW w AS (PARTITION BY episode_id ORDER BY frame_id)),
fw AS (SELECT episode_id, frame_id, step, n, cap, cap AS speed FROM e WHERE frame_id = 0 UNION ALL SELECT e.episode_id, e.frame_id, e.step, e.n, e.cap, least(e.cap, sqrt(fw.speed * fw.speed + 2 * 30 * e.step)) FROM fw JOIN e ON e.episode_id = fw.episode_id AND e.frame_id = fw.frame_id + 1),
ahead AS (SELECT *, lead(step) OVER (PARTITION BY episode_id ORDER BY frame_id) AS next_step FROM fw),
bw AS (SELECT episode_id, frame_id, speed AS out FROM ahead WHERE frame_id = n - 1 UNION ALL SELECT a.episode_id, a.frame_id, least(a.speed, sqrt(bw.out * bw.out + 2 * 30 * a.next_step)) FROM bw JOIN ahead a ON a.episode_id = bw.episode_id AND a.frame_id = bw.frame_id - 1)
SELECT episode_id, frame_id, round(out, 4) AS speed FROM bw""")
def reachable_speed(spark, d):
    c = sequence.curvature_cap(frame_table(spark, d), "episode_id", ["frame_id"], "actual_x_cm", "actual_y_cm", 100.0, 120.0, 20.0)
    return sequence.reachable_speed(c, "episode_id", "frame_id", "actual_x_cm", "actual_y_cm", "cap", 30.0).select("episode_id", "frame_id", F.round("speed", 4).alias("speed"))


@query(f"""WITH {FRAMES}, e AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY episode_id) AS n, first_value(x) OVER w AS x0, last_value(x) OVER (PARTITION BY episode_id ORDER BY frame_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS x1, sum(x) OVER (PARTITION BY episode_id ORDER BY frame_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS s FROM g WINDOW w AS (PARTITION BY episode_id ORDER BY frame_id))
SELECT episode_id, frame_id, round(CASE WHEN i = 1 OR i = n OR n < 7 THEN x ELSE (s + greatest(4 - i, 0) * x0 + greatest(i + 3 - n, 0) * x1) / 7 END, 6) AS smoothed FROM e""")
def smoothed_edges(spark, d):
    return sequence.smoothed_edges(frame_table(spark, d), "episode_id", ["frame_id"], "actual_x_cm", 3).select("episode_id", "frame_id", F.round("smoothed", 6).alias("smoothed"))


@query(f"""WITH {FRAMES}, e AS (SELECT *, degrees(atan2(y - lag(y) OVER w, x - lag(x) OVER w)) AS din, degrees(atan2(lead(y) OVER w - y, lead(x) OVER w - x)) AS dout FROM g WINDOW w AS (PARTITION BY episode_id ORDER BY frame_id))
SELECT episode_id, frame_id FROM e WHERE din IS NULL OR dout IS NULL OR {_WRAP.format('dout - din + 180')} >= 90""")
def corners(spark, d):
    return sequence.corners(frame_table(spark, d), "episode_id", ["frame_id"], "actual_x_cm", "actual_y_cm", 90.0).select("episode_id", "frame_id")


@query(f"""WITH {FRAMES}, o AS (SELECT episode_id, frame_id, greatest(abs(value_x), 0) > 50 AS opposing, centre AS along FROM (SELECT *, x - 100 AS value_x FROM g WHERE frame_id % 10 <> 0)),
e AS (SELECT *, opposing AND NOT coalesce(lag(opposing) OVER (PARTITION BY episode_id ORDER BY frame_id), false) AS entry FROM o)
SELECT episode_id, count(*) FILTER (NOT opposing) AS n_free, count(*) FILTER (opposing) AS n_blocked, round(median(along) FILTER (NOT opposing), 6) AS free_median_cm, round(median(along) FILTER (opposing), 6) AS blocked_median_cm FROM e WHERE NOT entry GROUP BY 1""")
def physics_consistency(spark, d):
    f = frame_table(spark, d)
    hits = F.when(F.abs(F.col("actual_x_cm") - 100) > 50, F.lit('[{"impact_normal": [0.0, 0.0, 1.0]}, {"impact_normal": [-1.0, 0.0, 0.0]}]')).otherwise(F.lit("[]"))
    told = f.select("episode_id", "frame_id", F.when(F.col("frame_id") % 10 != 0, 1.0).otherwise(0.0).alias("cmd_move_forward"), F.lit(0.0).alias("actual_yaw_deg"), F.col("depth_centre_m").alias("step_x_cm"), F.lit(5.0).alias("step_y_cm"), hits.alias("collision_hits"))
    r = rollups.physics_consistency(told, "episode_id")
    return r.select("episode_id", "n_free", "n_blocked", F.round("free_median_cm", 6).alias("free_median_cm"), F.round("blocked_median_cm", 6).alias("blocked_median_cm"))


@query(f"""WITH {FRAMES}, t AS (SELECT *, sqrt(pow(lead(x) OVER w - x, 2) + pow(lead(y) OVER w - y, 2) + pow(lead(z) OVER w - z, 2)) AS step, {_WRAP.format('lead(yaw) OVER w - yaw + 540')} AS turn FROM g WINDOW w AS (PARTITION BY episode_id ORDER BY frame_id))
SELECT episode_id, count(*) FILTER (x > 270) AS collision_count, count(*) FILTER (x < 6) AS penetration_count, round(min(CASE WHEN centre > 20 THEN centre END), 6) AS min_clearance_cm, round(coalesce(max(step), 0), 6) AS max_step_cm, round(coalesce(max(turn), 0), 6) AS max_turn_deg, count(*) FILTER (x > 270) = 0 AND count(*) FILTER (x < 6) = 0 AS collision_free, coalesce(array_to_string(list(frame_id ORDER BY frame_id) FILTER (x > 270)[1:12], ','), '') AS first_hits FROM t GROUP BY 1""")
def collision_report(spark, d):
    f = frame_table(spark, d)
    c = F.col
    p = f.select("episode_id", c("frame_id").alias("frame"), c("actual_x_cm").alias("x"), c("actual_y_cm").alias("y"), c("actual_z_cm").alias("z"), c("actual_yaw_deg").alias("yaw"), (c("actual_x_cm") > 270).alias("sweep_hit"), (c("actual_x_cm") < 6).alias("near_hit"), F.when(c("depth_centre_m") > 20, c("depth_centre_m")).alias("clearance_cm"))
    r = rollups.collision_report(p, "episode_id", FPS)
    return r.select("episode_id", "collision_count", "penetration_count", *[F.round(n, 6).alias(n) for n in ("min_clearance_cm", "max_step_cm", "max_turn_deg")], "collision_free", F.array_join("first_hits", ",").alias("first_hits"))


@query(f"SELECT user_id, event_type, (count(e.event_type)) AS n, round(count(e.event_type) / any_value(total), 9) AS share FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN (SELECT unnest(['click', 'view', 'hold']) AS event_type) l LEFT JOIN events e USING (user_id, event_type) JOIN (SELECT user_id, count(*) AS total FROM events GROUP BY 1) t USING (user_id) GROUP BY 1, 2")
def label_shares(spark, d):
    r = rollups.label_shares(table(spark, d, "events"), "user_id", "event_type", ["click", "view", "hold"])
    return r.select("user_id", "event_type", "n", F.round("share", 9).alias("share"))


@query(f"SELECT user_id, bool_and(isfinite(value)) AS finite, bool_and(up) AS increasing, count(*) = max(60 + user_id % 20) AS complete FROM (SELECT *, coalesce(event_id > lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id), true) AS up FROM events) GROUP BY 1")
def integrity(spark, d):
    e = _events(spark, d).withColumn("declared", 60 + F.col("user_id") % 20).withColumn("at", F.struct("ts", "event_id"))
    return rollups.integrity(e, "user_id", "at", "event_id", "value", "declared")
