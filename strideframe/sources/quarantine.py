"""Scans that keep the well-formed prefix of each file and count what they refuse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

STATE = "frame_id long, phase string, desired_location array<double>, actual_location array<double>, desired_rotation_pyr array<double>, actual_rotation_pyr array<double>, quat_xyzw array<double>, depth struct<valid_fraction double, min_m double, max_m double, centre_m double, bit_depth int>"
#: fixed values: fields without which a state is no row
REQUIRED_STATE = ("frame_id", "actual_location", "actual_rotation_pyr", "desired_location", "desired_rotation_pyr", "quat_xyzw", "depth")
REQUIRED_DEPTH = ("bit_depth", "valid_fraction", "min_m", "max_m", "centre_m")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no (from 0) and value of every line under path; a large file may be split, its lines keep their numbers."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    return raw.select("file", (F.row_number().over(W.partitionBy("file").orderBy("_block", "_id")) - 1).alias("line_no"), "value")


def keep_prefix(rows: DataFrame, group: str, number: str, ok: Column) -> DataFrame:
    """Rows of each group before its first row that is not ok, with n_refused, the count of rows from there on."""
    w = W.partitionBy(group)
    marked = rows.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    marked = marked.withColumn("_torn", F.min(F.when(~F.col("_ok"), F.col(number))).over(w)).withColumn("n_refused", F.count_if(F.col(number) >= F.col("_torn")).over(w))
    return marked.where(F.col("_torn").isNull() | (F.col(number) < F.col("_torn"))).drop("_ok", "_torn")


def read_frames(spark: SparkSession, path: str, schema: str, refuse: bool = False) -> DataFrame:
    """CSV rows with a header, checked for width and types: the rows before each file's first malformed line.

    Adds file, line_no and n_refused. With ``refuse`` a malformed line raises instead. Blank lines are no rows; an
    empty field is null. Fields may be quoted but not hold line breaks.
    """
    names = StructType.fromDDL(schema).fieldNames()
    body = lines(spark, path).where("line_no > 0 AND trim(value) <> ''")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = body.withColumn("s", F.from_csv("value", schema + ", _bad string", options))
    ok = F.col("s._bad").isNull()
    if refuse:
        complaint = F.concat(F.lit("malformed line "), F.col("line_no").cast("string"), F.lit(" of "), F.col("file"))
        kept = parsed.where(F.when(ok, True).otherwise(F.raise_error(complaint).cast("boolean"))).withColumn("n_refused", F.lit(0).cast("long"))
    else:
        kept = keep_prefix(parsed, "file", "line_no", ok)
    return kept.select(*[F.col(f"s.{n}").alias(n) for n in names], "file", "line_no", "n_refused")


def valid_state(s: str = "s") -> Column:
    """All required fields of a parsed state are there, at both levels."""
    out = F.lit(True)
    for name in (*REQUIRED_STATE, *(f"depth.{n}" for n in REQUIRED_DEPTH)):
        out = out & F.col(f"{s}.{name}").isNotNull()
    return out


def parse_states(rows: DataFrame, episode: str = "episode_id", number: str = "line_no", text: str = "value") -> DataFrame:
    """JSON lines -> states before the first torn line of each episode; n_torn counts it and what follows. Blank lines are no rows."""
    parsed = rows.where(F.trim(text) != "").withColumn("s", F.from_json(text, STATE))
    return keep_prefix(parsed, episode, number, valid_state()).select(episode, "s.*", F.col("n_refused").alias("n_torn"))
