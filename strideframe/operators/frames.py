"""The per-frame table: engine states to flat rows with errors, steps and rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strideframe.functions import geometry as G


def _vector(name: str) -> list[Column]:
    return [F.get(F.col(name), i) for i in range(3)]


def distance(a: list[Column], b: list[Column]) -> Column:
    return F.sqrt(sum(((x - y) * (x - y) for x, y in zip(a, b, strict=True)), F.lit(0.0)))


def build_frames(states: DataFrame, fps: float, total: int | None = None) -> DataFrame:
    """Engine states (one row a frame) -> frame rows; the first row of an episode has step and rates 0.

    total: frames to keep of each episode, all if it is None.
    """
    w = W.partitionBy("episode_id").orderBy("frame_id")
    (al, ar), (dl, dr) = [[_vector(f"{s}_location"), _vector(f"{s}_rotation_pyr")] for s in ("actual", "desired")]
    before = [F.lag(x).over(w) for x in al]
    step = F.coalesce(distance(al, before), F.lit(0.0))
    turn = F.coalesce(G.wrapped_diff(ar[1], F.lag(ar[1]).over(w)), F.lit(0.0))
    rows = states.withColumns({"step_cm": step, "_turn": turn, "_place": F.row_number().over(w)})
    if total is not None:
        rows = rows.where(F.col("_place") <= total)
    axes, angles = ("x", "y", "z"), ("pitch", "yaw", "roll")
    pose = [v.alias(f"{side}_{a}_{unit}") for side, place, turned in (("desired", dl, dr), ("actual", al, ar)) for names, values, unit in ((axes, place, "cm"), (angles, turned, "deg")) for a, v in zip(names, values, strict=True)]
    matrix = G.camera_to_world(*al, *ar)
    return rows.select(
        "episode_id", "frame_id", (F.col("frame_id") / F.lit(float(fps))).alias("episode_time_s"), F.coalesce("phase", F.lit("")).alias("phase"), *pose,
        distance(al, dl).alias("pos_error_cm"), G.wrapped_diff(ar[1], dr[1]).alias("yaw_error_deg"),
        "step_cm", (F.col("step_cm") / 100 * fps).alias("speed_m_s"), (F.col("_turn") * fps).alias("yaw_rate_deg_s"),
        *[F.get("quat_xyzw", i).alias(f"quat_{a}") for i, a in enumerate("xyzw")],
        F.array_join(F.transform(matrix, lambda v: F.format_string("%.6f", v)), " ").alias("c2w"),
        F.format_string("depth/%06d.exr", "frame_id").alias("depth_path"), F.col("depth.bit_depth").alias("depth_bit_depth"), F.col("depth.valid_fraction").alias("depth_valid_fraction"),
        F.col("depth.min_m").alias("depth_min_m"), F.col("depth.max_m").alias("depth_max_m"), F.col("depth.centre_m").alias("depth_centre_m"),
        F.format_string("rgb/%06d.jpg", "frame_id").alias("rgb_path"),
    )


def frame_summary(frames: DataFrame) -> DataFrame:
    """Pose errors and peaks of each episode."""
    a = lambda f, c, out: f(c).alias(out)
    return frames.groupBy("episode_id").agg(
        F.count(F.lit(1)).alias("frames"), a(F.avg, "pos_error_cm", "pos_error_mean"), a(F.max, "pos_error_cm", "pos_error_max"), a(F.avg, "yaw_error_deg", "yaw_error_mean"),
        a(F.max, "yaw_error_deg", "yaw_error_max"), a(F.max, "speed_m_s", "speed_max"), a(F.max, "yaw_rate_deg_s", "yaw_rate_max"),
    )


def frame_motion(frames: DataFrame) -> DataFrame:
    """episode_id, frame_id, moved_cm, turned_deg to the next row; the last row of an episode has none."""
    w = W.partitionBy("episode_id").orderBy("frame_id")
    here, turned = [F.col(f"actual_{a}_cm") for a in "xyz"], [F.col(f"actual_{a}_deg") for a in ("pitch", "yaw", "roll")]
    after = [F.lead(x).over(w) for x in here]
    turn = F.greatest(*[G.wrapped_diff(a, F.lead(a).over(w)) for a in turned])
    return frames.select("episode_id", "frame_id", distance(here, after).alias("moved_cm"), turn.alias("turned_deg")).where("moved_cm IS NOT NULL")


def motion_class() -> Column:
    """turn before moving before static, from moved_cm and turned_deg."""
    return F.when(F.col("turned_deg") > 0.05, "turn").when(F.col("moved_cm") > 0.5, "moving").otherwise("static")


def pair_kind(moving: bool) -> Column:
    """Pairs that certainly moved, or certainly stood: what lies between is neither."""
    m, t = F.col("moved_cm"), F.col("turned_deg")
    return (m > 0.5) | (t > 0.05) if moving else (m < 0.01) & (t < 0.01)


def planar_speed(frames: DataFrame, fps: float, phases: tuple[str, ...] = ("forward", "backward")) -> DataFrame:
    """episode_id, frame_id, planar_m_s between walking rows whose numbers follow each other."""
    w = W.partitionBy("episode_id").orderBy("frame_id")
    walking = frames.where(F.col("phase").isin(*phases))
    dx, dy = [F.lead(f"actual_{a}_cm").over(w) - F.col(f"actual_{a}_cm") for a in "xy"]
    return walking.select("episode_id", "frame_id", F.lead("frame_id").over(w).alias("_next"), (F.hypot(dx, dy) / 100 * fps).alias("planar_m_s")).where("_next = frame_id + 1").drop("_next")


def static_runs(motion: DataFrame) -> DataFrame:
    """Frames whose own pair and the next one are both static: (episode_id, frame_id)."""
    static = motion.where(pair_kind(moving=False)).select("episode_id", "frame_id")
    after = static.select("episode_id", (F.col("frame_id") - 1).alias("frame_id"))
    return static.join(after, ["episode_id", "frame_id"], "left_semi")


def replay_diff(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Two recordings of one plan, frame by frame; an episode with unequal frame counts raises.

    episode_id, frame_id and the absolute difference of each column.
    """
    count = lambda df, name: df.groupBy("episode_id").agg(F.count(F.lit(1)).alias(name))
    both = count(left, "a").join(count(right, "b"), "episode_id", "full")
    message = F.concat(F.lit("frame counts differ: "), F.col("episode_id").cast("string"))
    checked = both.where(F.when(F.col("a").eqNullSafe(F.col("b")), True).otherwise(F.raise_error(message).cast("boolean"))).select("episode_id")
    l = left.select("episode_id", "frame_id", *[F.col(c).alias(f"l_{c}") for c in columns])
    r = right.select("episode_id", "frame_id", *[F.col(c).alias(f"r_{c}") for c in columns])
    return l.join(checked, "episode_id", "left_semi").join(r, ["episode_id", "frame_id"]).select("episode_id", "frame_id", *[F.abs(F.col(f"l_{c}") - F.col(f"r_{c}")).alias(c) for c in columns])
