"""Leases, latest-wins state, stalls and requeues over event streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def lease_sessions(beats: DataFrame, slug: str, at: str, lease: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of heartbeats: a lease ends ``lease`` after its last beat. Batch and stream alike."""
    if beats.isStreaming:
        beats = beats.withWatermark(at, late)
    return beats.groupBy(F.col(slug), F.session_window(at, lease).alias("s")).agg(F.count(F.lit(1)).alias("beats")).select(slug, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "beats")


def latest_upsert(state: DataFrame, news: DataFrame, key: str, at: str) -> DataFrame:
    """Latest row per key of the old state and a micro-batch; for foreachBatch. Of equal times the greater row counts."""
    rows = state.unionByName(news)
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), F.struct(at, *[c for c in rows.columns if c not in (key, at)])).alias("r")).select("r.*")


def keep_snapshot(stream: DataFrame, path: str, checkpoint: str, key: str, at: str):
    """Run a stream into a latest-per-key table: a snapshot folder per batch under ``path``, made from the one before.

    A repeated batch rewrites its own folder, so the newest complete folder is always the state after whole batches.
    """

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = f"{path}/batch={number - 1}"
        state = spark.read.schema(batch.schema).parquet(before) if number else batch.limit(0)
        latest_upsert(state, batch, key, at).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stall_alarms(beats: DataFrame, slug: str, counter: str, at: str, seconds: int, late: str = "0 seconds") -> DataFrame:
    """slug, counter, since: raised once the event clock has run ``seconds`` past a counter's last change.

    A stream with a watermark on ``at``; state per slug is the counter and when it last changed, whatever the number of beats.
    """

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            value, since = state.get
            state.remove()
            yield pd.DataFrame({slug: [key[0]], counter: [value], "since": [pd.Timestamp(since, unit="us")]})
            return
        rows = pd.concat(list(parts)).sort_values([at, counter])
        value, since = state.get if state.exists else (None, None)
        for v, t in zip(rows[counter], rows[at], strict=True):
            if value is None or v != value:
                value, since = int(v), int(t.value // 1000)
        state.update((value, since))
        state.setTimeoutTimestamp(max(since // 1000 + seconds * 1000, state.getCurrentWatermarkMs() + 1))
        return
        yield

    kinds = {c: beats.schema[c].dataType.simpleString() for c in (slug, counter)}
    watched = beats.withWatermark(at, late).select(slug, counter, at)
    return watched.groupBy(slug).applyInPandasWithState(run, f"{slug} {kinds[slug]}, {counter} {kinds[counter]}, since timestamp", "value long, since long", "append", GroupStateTimeout.EventTimeTimeout)


def requeue_state(handled: DataFrame, failures: DataFrame, key: str, most: int = 2) -> DataFrame:
    """Counter per key after a batch of failures: key, handled, action of this batch (requeue, give_up, none).

    handled: key, handled of earlier batches; failures: key. A key never rises above ``most``.
    """
    new = failures.groupBy(key).agg(F.count(F.lit(1)).alias("_new"))
    both = handled.select(key, "handled").join(new, key, "full").select(key, F.coalesce("handled", F.lit(0)).cast("long").alias("_old"), F.coalesce("_new", F.lit(0)).alias("_new"))
    action = F.when(F.col("_new") == 0, "none").when(F.col("_old") < most, "requeue").otherwise("give_up")
    return both.select(key, F.least(F.col("_old") + F.col("_new"), F.lit(most)).cast("long").alias("handled"), action.alias("action"))


def of_this_run(rows: DataFrame, finished: str, cutoff: Column) -> DataFrame:
    """Rows finished after the cut-off; what an earlier run left behind, or what has no time, is dropped."""
    return rows.where(F.col(finished) > cutoff)
