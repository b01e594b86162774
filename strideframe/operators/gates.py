"""Acceptance gates: one aggregate per episode, unpivoted to (episode, gate, result, detail).

A result is pass, FAIL, warn (an advisory gate that does not hold) or skip (not measurable here). A
gate whose ``present`` is false gives no row at all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: fixed values: upper end of each speed tier (m/s), closure limits by kind of return (cm, deg), the judged actions
TIER_HIGH = {"slow": 0.6, "medium": 1.0, "fast": 1.5}
CLOSURE = {"exact": (2.0, 1.0), "near": (100.0, 10.0), "partial": (400.0, 45.0)}
ACTIONS = ("forward", "backward", "turn_left", "turn_right", "look_up", "look_down")
#: gates that nothing here can measure; they are reported as skipped
NOT_EVALUATED = ("depth_visible_overlap", "fully_occluded_interval", "instance_semantic_masks")

#: what an episode's own record says, beside its frames
LIMITS = (
    "episode_id long, fps double, frozen_frames long, ended_early_reason string, jpegs long, decoded long, unreadable long, blank long, duplicate_pairs long,"
    " width int, height int, k_width int, k_height int, log_proven boolean, material_failures long, axis_pass boolean, reach_available boolean, reachable boolean,"
    " collision_free boolean, max_translation_cm double, yaw_deg_per_s double, family string, revisit_applicable boolean, anchor_end long, requested_age_s double,"
    " realised_age_s double, revisit_kind string, translation_error_cm double, rotation_error_deg double,"
    " matches long, speed_tier string, speed_pinned boolean, pin_m_s double, pitch_limit_deg double, roll_limit_deg double, depth_missing long, penetrating_frames long,"
    " coverage_fraction double,"
    " revisit_events array<struct<requested_age_s double, realised_age_s double, translation_error_cm double, rotation_error_deg double>>, mix_target map<string,array<double>>"
)


@dataclass(frozen=True)
class Gate:
    name: str
    passes: Column
    detail: Column
    applies: Column | None = None
    advisory: bool = False
    present: Column | None = None


def frame_aggregates(frames: DataFrame, limits: DataFrame) -> DataFrame:
    """One row per episode: everything the frame gates need, from one window and one aggregate.

    Planar speed is taken between a walking row and its successor only where the successor's number
    is the next one. Empty depth fields do not count; a depth of zero or less does.
    """
    c = F.col
    w = W.partitionBy("episode_id").orderBy("frame_id")
    walks = c("phase").isin("forward", "backward")
    step = F.hypot(F.lead("actual_x_cm").over(w) - c("actual_x_cm"), F.lead("actual_y_cm").over(w) - c("actual_y_cm"))
    adjacent = walks & F.lead(walks).over(w) & (F.lead("frame_id").over(w) == c("frame_id") + 1)
    rows = frames.join(limits.select("episode_id", "fps"), "episode_id").withColumns({"planar": F.when(adjacent, step / 100 * c("fps")), "walking_speed": F.when(walks, c("speed_m_s"))})
    at = lambda name, q: F.percentile(name, q)
    return rows.groupBy("episode_id").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.abs(c("episode_time_s") - c("frame_id") / c("fps"))).alias("time_error"),
        F.max("pos_error_cm").alias("max_pos_error"), at("pos_error_cm", 0.99).alias("p99_pos_error"), F.max("yaw_error_deg").alias("max_yaw_error"),
        F.max("yaw_rate_deg_s").alias("max_yaw_rate"), at("speed_m_s", 0.95).alias("p95_speed"),
        F.coalesce(at("planar", 0.5), at("walking_speed", 0.5), at("speed_m_s", 0.5)).alias("walk_median"), F.coalesce(at("planar", 0.95), at("walking_speed", 0.95), at("speed_m_s", 0.95)).alias("walk_p95"),
        F.max(F.abs("actual_pitch_deg")).alias("max_pitch"), F.max(F.abs("actual_roll_deg")).alias("max_roll"), F.count(F.nullif("depth_path", F.lit(""))).alias("n_depth"),
        F.count("depth_valid_fraction").alias("n_valid"), F.count_if(c("depth_valid_fraction") <= 0.001).alias("dead_depth"), F.min("depth_min_m").alias("min_depth"), F.max("depth_max_m").alias("max_depth"),
        *[F.count_if(c("phase") == a).alias(f"n_{a}") for a in (*ACTIONS, "hold")],
    )


def frame_gates() -> list[Gate]:
    """All gates over the aggregates of :func:`frame_aggregates` joined with a LIMITS row."""
    c = F.col
    text = lambda *names: F.concat_ws(" ", *[F.concat(F.lit(n + "="), F.coalesce(c(n).cast("string"), F.lit("-"))) for n in names])
    few = lambda n, of: c(n) <= F.floor(0.005 * c(of))
    returns = c("revisit_applicable")
    events = F.coalesce(c("revisit_events"), F.array().cast("array<struct<requested_age_s double, realised_age_s double, translation_error_cm double, rotation_error_deg double>>"))
    alone = F.array(F.struct(*[c(x) for x in ("requested_age_s", "realised_age_s", "translation_error_cm", "rotation_error_deg")]))
    judged = F.when(F.size(events) > 0, events).otherwise(alone)
    in_time = F.forall(judged, lambda e: F.abs(e["realised_age_s"] - e["requested_age_s"]) <= F.greatest(F.lit(0.5), 0.05 * e["requested_age_s"]))
    limit = lambda i: F.coalesce(*[F.when(c("revisit_kind") == k, F.lit(v[i])) for k, v in CLOSURE.items()], F.lit(CLOSURE["near"][i]))
    closed = F.forall(judged, lambda e: (e["translation_error_cm"] <= limit(0)) & (e["rotation_error_deg"] <= limit(1)))
    high = F.coalesce(*[F.when(c("speed_tier") == k, F.lit(v)) for k, v in TIER_HIGH.items()])
    pinned = c("speed_pinned") & (c("pin_m_s") > 0)
    deep, walk = c("n_depth") > 0, c("family") == "coverage_walk"
    share = F.map_from_arrays(F.array(*[F.lit(a) for a in (*ACTIONS, "hold")]), F.array(*[c(f"n_{a}") / c("n") for a in (*ACTIONS, "hold")]))
    banded = F.forall(F.map_entries("mix_target"), lambda e: F.coalesce(F.try_element_at(share, e["key"]), F.lit(0.0)).between(F.get(e["value"], 0) - 0.01, F.get(e["value"], 1) + 0.01))
    yes = F.lit(True)
    return [
        Gate("frame_count_matches_frozen", c("ended_early_reason").isNotNull() | (c("n") == c("frozen_frames")), text("n", "frozen_frames", "ended_early_reason")),
        Gate("time_base_exact", c("time_error") < 1e-9, text("time_error")),
        Gate("all_frames_present", c("jpegs") == c("n"), text("jpegs", "n")),
        Gate("frames_decode", c("unreadable") == 0, text("unreadable", "decoded")),
        Gate("resolution_matches_K", (c("width") == c("k_width")) & (c("height") == c("k_height")), text("width", "height")),
        Gate("no_blank_frames", few("blank", "decoded"), text("blank", "decoded")),
        Gate("no_duplicate_frames", c("duplicate_pairs") == 0, text("duplicate_pairs")),
        Gate("materials_compiled", c("material_failures") == 0, text("material_failures"), c("log_proven")),
        Gate("axis_semantics", c("axis_pass"), text("axis_pass")),
        Gate("pose_tracking", (c("max_pos_error") < 2) & (c("max_yaw_error") < 0.5), text("max_pos_error", "p99_pos_error", "max_yaw_error")),
        Gate("route_reachable", c("reachable"), text("reachable"), c("reach_available"), present=c("reach_available").isNotNull()),
        Gate("collision_free", c("collision_free"), text("collision_free")),
        Gate("frame_translation_bounded", c("max_translation_cm") < 50, text("max_translation_cm")),
        Gate("frame_rotation_bounded", c("max_yaw_rate") <= 1.5 * F.coalesce("yaw_deg_per_s", F.lit(60.0)), text("max_yaw_rate", "yaw_deg_per_s")),
        Gate("revisit_age_matches_request", in_time, F.to_json(judged), returns),
        Gate("memory_anchor_is_not_first_frame", c("anchor_end") > 0, text("anchor_end"), returns),
        Gate("revisit_pose_closure", closed, F.to_json(judged), returns),
        Gate("speed_within_tier", c("p95_speed") <= 1.25 * high, text("p95_speed", "speed_tier")),
        Gate("speed_pinned_held", (F.abs(c("walk_median") - c("pin_m_s")) <= 0.02 * c("pin_m_s")) & (c("walk_p95") <= 1.02 * c("pin_m_s")), text("walk_median", "walk_p95", "pin_m_s"), present=pinned),
        Gate("attitude_within_limits", (c("max_pitch") <= c("pitch_limit_deg") + 0.5) & (c("max_roll") <= c("roll_limit_deg") + 0.5), text("max_pitch", "max_roll")),
        Gate("revisit_view_overlap_proxy", c("matches") >= 50, text("matches"), returns & c("matches").isNotNull()),
        Gate("metric_depth_present", (c("depth_missing") == 0) & (c("n_depth") == c("n")), text("n_depth", "n", "depth_missing"), deep),
        Gate("depth_not_empty", few("dead_depth", "n_valid"), text("dead_depth", "n_valid"), present=deep & (c("n_valid") > 0)),
        Gate("depth_range_plausible", (c("min_depth") > 0.05) & (c("max_depth") < 1000), text("min_depth", "max_depth"), present=deep & (c("n_valid") > 0)),
        Gate("no_geometry_penetration", c("penetrating_frames") == 0, text("penetrating_frames"), c("penetrating_frames").isNotNull(), present=deep),
        *[Gate(name, yes, F.lit("not measured"), F.lit(False)) for name in NOT_EVALUATED],
        Gate("road_coverage_complete", c("coverage_fraction") == 1.0, text("coverage_fraction"), present=walk),
        Gate("action_mix_in_band", F.coalesce(banded, yes), F.to_json(share), advisory=True, present=walk),
        Gate("all_six_actions_present", F.least(*[c(f"n_{a}") for a in ACTIONS]) > 0, text(*[f"n_{a}" for a in ACTIONS]), present=walk),
    ]


def acceptance(frames: DataFrame, limits: DataFrame) -> DataFrame:
    """(episode_id, gate, result, detail) of every gate, from a frame table and one LIMITS row an episode.

    An episode without frames gives no rows. A measure that is null where its gate applies is skip; only
    what must be there (coverage, resolution, flags) fails when it is null.
    """
    strict = ("road_coverage_complete", "axis_semantics", "collision_free", "resolution_matches_K", "frame_count_matches_frozen")
    rules = [Gate(g.name, F.coalesce(g.passes, F.lit(False)) if g.name in strict else g.passes, g.detail, g.applies, g.advisory, g.present) for g in frame_gates()]
    return judge(frame_aggregates(frames, limits).join(limits, "episode_id"), "episode_id", rules)


def judge(wide: DataFrame, key: str, gates: list[Gate]) -> DataFrame:
    """One row per (key, gate). A gate that does not apply, or cannot be measured, is skip, never pass."""
    sure = lambda x: F.coalesce(x if x is not None else F.lit(True), F.lit(False))
    rows = [
        F.struct(F.lit(g.name).alias("gate"), F.when(~sure(g.present), None).when(~sure(g.applies) | g.passes.isNull(), "skip").when(g.passes, "pass").otherwise("warn" if g.advisory else "FAIL").alias("result"), g.detail.alias("detail"))
        for g in gates
    ]
    return wide.select(key, F.inline(F.array(*rows))).where("result IS NOT NULL")


def verdicts(gates: DataFrame, key: str) -> DataFrame:
    """A warn counts as passed; accepted_strict is null when nothing was evaluated."""
    agg = gates.groupBy(key).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("result") == "FAIL").alias("failed"), F.count_if(F.col("result") == "skip").alias("skipped"), F.array_sort(F.collect_list(F.when(F.col("result") == "FAIL", F.col("gate")))).alias("failed_gates"))
    return agg.withColumn("passed", F.col("total") - F.col("failed") - F.col("skipped")).withColumn("accepted_strict", F.when(F.col("skipped") < F.col("total"), F.col("failed") == 0))


def carry_verdicts(old: DataFrame, new: DataFrame, key: str, judged_again: list[str]) -> DataFrame:
    """New verdicts where the gate was judged again, else the old ones: key, gate, result, origin.

    A gate that only one side has keeps that side's verdict.
    """
    o = old.select(key, "gate", F.col("result").alias("old_result"))
    n = new.select(key, "gate", F.col("result").alias("new_result"))
    again = F.col("gate").isin(judged_again) & F.col("new_result").isNotNull() | F.col("old_result").isNull()
    return o.join(n, [key, "gate"], "full").select(key, "gate", F.when(again, F.col("new_result")).otherwise(F.col("old_result")).alias("result"), F.when(again, "new").otherwise("carried").alias("origin"))


def pre_gates(plan: DataFrame) -> DataFrame:
    """(plan_id, gate, ok) of the eight checks before a recording; retrace counts only where it was asked for."""
    c = F.col
    sure = lambda x: F.coalesce(x, F.lit(False))
    rules = {
        "frame_translation_bounded": c("max_translation_cm") < 50, "frame_rotation_bounded": c("max_yaw_rate") <= c("yaw_limit"), "attitude_within_limits": c("max_pitch") <= c("pitch_limit_deg") + 0.5,
        "collision_free": c("collision_free"), "depth_probe_clear": c("probe_clear"), "coverage_complete": c("coverage_fraction") >= 1, "action_mix_in_band": c("mix_in_band"),
        "retrace_cadence_ok": ~sure(c("retrace_requested")) | F.coalesce(c("cadence_ok"), F.lit(True)),
    }
    return plan.select("plan_id", F.inline(F.array(*[F.struct(F.lit(k).alias("gate"), sure(v).alias("ok")) for k, v in rules.items()])))
