"""What the acceptance gates know of files and pictures: counted from listings, decoded pictures, depths and matches.

Each function gives one row per episode with columns of ``gates.LIMITS``; :func:`limits_with_evidence` joins them to the
episodes' own records. An episode that a source says nothing of keeps null there, which the gates report as skipped, but for
counts of files, where nothing listed is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strideframe.operators.sequence import islands

#: fixed values: a nearer depth (m) counts as near, so large a share of the picture as inside geometry, a depth on the near plane
NEAR_M, NEAR_SHARE, CLIP_M = 0.60, 0.20, 0.11
#: fixed values: a picture spans fewer grey levels and is blank; a pair differs less on average and is a repeat
BLANK_SPAN, REPEAT_DIFF = 2, 0.05
DESIRED = ("desired_x_cm", "desired_y_cm", "desired_z_cm", "desired_yaw_deg", "desired_pitch_deg")


def _within(files: DataFrame) -> DataFrame:
    """episode_id, at: the episode is the first folder of ``path``, at the rest."""
    return files.select(F.substring_index("path", "/", 1).alias("episode_id"), F.expr("substring(path, instr(path, '/') + 1)").alias("at"))


def picture_files(files: DataFrame) -> DataFrame:
    """episode_id, jpegs: pictures right in the episode's rgb folder. files: path (episode/..)."""
    return _within(files).where(F.col("at").rlike("^rgb/[^/]*[.]jpg$")).groupBy("episode_id").agg(F.count(F.lit(1)).alias("jpegs"))


def missing_depth(frames: DataFrame, files: DataFrame) -> DataFrame:
    """episode_id, depth_missing: frames whose depth_path (within the episode) is not listed. Frames without a path are not missing here."""
    told = frames.where(F.coalesce("depth_path", F.lit("")) != "").select(F.col("episode_id").cast("string").alias("episode_id"), F.col("depth_path").alias("at"))
    known = _within(files).distinct().withColumn("there", F.lit(True))
    return told.join(known, ["episode_id", "at"], "left").groupBy("episode_id").agg(F.count_if(F.col("there").isNull()).alias("depth_missing"))


def moved() -> Column:
    """The camera was told to move from this frame to the next: unknown values count as moves."""
    w = W.partitionBy("episode_id").orderBy("frame_id")
    same = F.lit(True)
    for c in DESIRED:
        same = same & F.coalesce(F.abs(F.col(c).cast("double") - F.lead(F.col(c).cast("double")).over(w)) <= 1e-6, F.lit(False))
    return ~same


def picture_samples(frames: DataFrame, pictures: DataFrame, stride: int = 12) -> DataFrame:
    """episode_id, decoded, unreadable, blank, duplicate_pairs, width, height of every ``stride``-th frame and its successor.

    frames: episode_id, frame_id (0, 1, ..), DESIRED; pictures: episode_id, frame_id, luma (array of grey levels, null: not readable), width, height. A pair is looked
    at where the camera was told to move. The sizes are those of the first picture that could be read.
    """
    c = F.col
    w = W.partitionBy("episode_id").orderBy("frame_id")
    rows = frames.select("episode_id", "frame_id", *DESIRED).withColumns({"moved": moved(), "last": F.lead("frame_id").over(w).isNull()})
    wanted = rows.where(c("frame_id") % stride == 0).select("episode_id", "frame_id", (c("moved") & ~c("last")).alias("pair"))
    seen = pictures.where((c("frame_id") % stride).isin(0, 1 % stride)).select("episode_id", "frame_id", "luma", "width", "height")
    after = seen.select("episode_id", (c("frame_id") - 1).alias("frame_id"), c("luma").alias("next"))
    both = wanted.join(seen, ["episode_id", "frame_id"], "left").join(after, ["episode_id", "frame_id"], "left")
    read, pair = c("luma").isNotNull(), c("luma").isNotNull() & c("pair")
    diff = F.aggregate(F.zip_with("luma", "next", lambda a, b: F.abs(a.cast("double") - b)), F.lit(0.0), lambda s, x: s + x) / F.size("luma")
    size = lambda n: F.min_by(F.when(read, c(n)), F.when(read, c("frame_id"))).alias(n)
    return both.groupBy("episode_id").agg(
        F.count_if(read).alias("decoded"), (F.count_if(~read) + F.count_if(pair & c("next").isNull())).alias("unreadable"),
        F.count_if(read & (F.array_max("luma") - F.array_min("luma") < BLANK_SPAN)).alias("blank"), F.count_if(pair & (diff < REPEAT_DIFF)).alias("duplicate_pairs"), size("width"), size("height"),
    )


def near_frames(depths: DataFrame, stride: int = 2) -> DataFrame:
    """episode_id, frame_id, nearest, share of valid depths under NEAR_M, of every ``stride``-th frame with a valid depth. depths: episode_id, frame_id, depth (array, over 0: valid)."""
    valid = depths.where(F.col("frame_id") % stride == 0).select("episode_id", "frame_id", F.filter("depth", lambda z: z > 0).alias("z")).where(F.size("z") > 0)
    return valid.select("episode_id", "frame_id", F.array_min("z").alias("nearest"), (F.size(F.filter("z", lambda z: z < NEAR_M)) / F.size("z")).alias("share"))


def penetrations(depths: DataFrame, stride: int = 2, share: float = NEAR_SHARE) -> DataFrame:
    """episode_id, nearest, at_clip, penetrating_frames, events (first, last frame of runs at most two strides apart)."""
    near = near_frames(depths, stride)
    runs = islands(near.where(F.col("share") > share), "episode_id", "frame_id", 2 * stride)
    events = runs.groupBy("episode_id").agg(F.sum("n").alias("_n"), F.array_sort(F.collect_list(F.struct("first", "last"))).alias("_events"))
    sums = near.groupBy("episode_id").agg(F.min("nearest").alias("nearest"), F.count_if(F.col("nearest") <= CLIP_M).alias("at_clip"))
    none = F.array().cast(events.schema["_events"].dataType)
    return sums.join(events, "episode_id", "left").select("episode_id", "nearest", "at_clip", F.coalesce("_n", F.lit(0)).alias("penetrating_frames"), F.coalesce("_events", none).alias("events"))


def view_matches(found: DataFrame, descriptors: DataFrame, pair: str = "pair") -> DataFrame:
    """pair, matches: of each compared pair of pictures, also of those without a match. found: spatial.mutual_nearest(); descriptors: either side of it."""
    n = found.groupBy(pair).agg(F.count(F.lit(1)).alias("n"))
    return descriptors.select(pair).distinct().join(n, pair, "left").select(pair, F.coalesce("n", F.lit(0)).alias("matches"))


def limits_with_evidence(limits: DataFrame, counted: list[DataFrame], listed: list[DataFrame]) -> DataFrame:
    """LIMITS rows whose columns come from the evidence. counted: tables where no row means not known; listed: where it means 0.

    All are keyed by episode_id; columns that limits has too are replaced.
    """
    out = limits
    for part, known in [*((p, False) for p in counted), *((p, True) for p in listed)]:
        names = [c for c in part.columns if c != "episode_id" and c in limits.columns]
        part = part.select(F.col("episode_id").cast("string").alias("_e"), *[F.col(c).alias(f"_{c}") for c in names])
        out = out.join(part, F.col("episode_id").cast("string") == F.col("_e"), "left").drop("_e", *names)
        out = out.withColumnsRenamed({f"_{c}": c for c in names})
        if known:
            out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in names})
    return out.select(limits.columns)
