"""Exact dedup over an extendible-hash index on shared files.

The directory starts with one bucket and doubles whenever an overfull bucket already uses all its
bits, so bucket b owns one range of 64-bit keys (a key prefix of ``local depth`` bits). Rows go to
the task that owns their bucket; the owner reads them in key order, chains rows whose keys collide
and compares their bytes. The resulting index (bucket, key, chain position, digest, survivor, size)
is a table in the shared folder.

Copies are combined in the mapping tasks before anything moves, so a text that a third of all rows
carry reaches its owner once per mapping task. The key histogram the directory is built from has
at most 2**MAX_DEPTH rows whatever the input; a bucket still overfull at that depth stays one, longer,
chain and is read as a stream.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

MAX_DEPTH = 16
CAPACITY = 1000
FLUSH_BYTES = 32 << 20


class Directory:
    """Slots of MAX_DEPTH leading key bits -> bucket; grown by doubling."""

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY, max_depth: int = MAX_DEPTH):
        counts = np.zeros(1 << max_depth, dtype=np.int64)
        for slot, n in histogram.items():
            counts[slot] = n
        below = np.concatenate([[0], np.cumsum(counts)])
        self.max_depth, self.depth = max_depth, 0
        buckets = [(0, 0)]  # (prefix, local depth)
        full = True
        while full:
            full, grown = False, []
            for prefix, local in buckets:
                lo, hi = prefix << (max_depth - local), (prefix + 1) << (max_depth - local)
                if below[hi] - below[lo] > capacity and local < max_depth:
                    if local == self.depth:
                        self.depth += 1  # the directory doubles
                    grown += [(2 * prefix, local + 1), (2 * prefix + 1, local + 1)]
                    full = True
                else:
                    grown.append((prefix, local))
            buckets = grown
        self.buckets = sorted(buckets, key=lambda b: b[0] << (max_depth - b[1]))
        self.bucket_of_slot = np.zeros(1 << max_depth, dtype=np.int32)
        for b, (prefix, local) in enumerate(self.buckets):
            self.bucket_of_slot[prefix << (max_depth - local) : (prefix + 1) << (max_depth - local)] = b


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def _combine(bucket_of_slot: np.ndarray, bits: int):
    """Map side: one row for each distinct text seen since the last flush."""
    schema = pa.schema([("bucket", pa.int32()), ("key", pa.int64()), ("body", pa.binary()), ("keep_id", pa.int64()), ("n", pa.int64())])

    def run(batches):
        seen: dict[int, list[list]] = {}
        held = 0

        def flush():
            rows = [(k, *e) for k, chain in seen.items() for e in chain]
            if not rows:
                return None
            keys = np.array([r[0] for r in rows], dtype=np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket_of_slot[_slot(keys, bits)], pa.int32()), pa.array(keys), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())],
                schema=schema,
            )

        for batch in batches:
            for i, key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                chain = seen.setdefault(key, [])
                for entry in chain:
                    if entry[0] == body:
                        entry[1] = i if entry[1] is None or (i is not None and i > entry[1]) else entry[1]
                        entry[2] += 1
                        break
                else:
                    chain.append([body, i, 1])
                    held += len(body) + 64
            if held > FLUSH_BYTES:
                yield flush()
                seen.clear()
                held = 0
        if (last := flush()) is not None:
            yield last

    return run


def _own(batches):
    """Owner: rows arrive in (bucket, key) order; chain equal keys and compare bytes."""
    names = ["bucket", "key", "chain", "text_sha256", "keep_id", "group_size"]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
    at, chain = None, []

    def close(out):
        digests = set()
        for place, (body, keep, n) in enumerate(chain):
            digest = hashlib.sha256(body).hexdigest()
            if digest in digests:
                raise RuntimeError("two different texts share a SHA-256 digest")
            digests.add(digest)
            out.append((*at, place, digest, keep, n))

    for batch in batches:
        out: list[tuple] = []
        for bucket, key, body, keep, n in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
            if (bucket, key) != at:
                close(out)
                at, chain = (bucket, key), []
            for entry in chain:
                if entry[0] == body:
                    entry[1] = keep if entry[1] is None or (keep is not None and keep > entry[1]) else entry[1]
                    entry[2] += n
                    break
            else:
                chain.append([body, keep, n])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
    out = []
    close(out)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The written index: bucket, key, chain, text_sha256, keep_id, group_size; one row per distinct text."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(common.text_of(text_col)).alias("key"), common.text_of(text_col).cast("binary").alias("body"))
    slot = F.shiftrightunsigned("key", 64 - MAX_DEPTH).cast("int")
    histogram = base.select("key").distinct().groupBy(slot.alias("slot")).count()
    directory = Directory({r["slot"]: r["count"] for r in histogram.collect()}, capacity)
    pages = base.mapInArrow(_combine(directory.bucket_of_slot, MAX_DEPTH), "bucket int, key long, body binary, keep_id long, n long")
    owned = pages.repartition(F.col("bucket")).sortWithinPartitions("bucket", "key")
    return common.save(owned.mapInArrow(_own, "bucket int, key long, chain int, text_sha256 string, keep_id long, group_size long"), "exact-index")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per input row: id_col, keep_id, group_size, kept, text_sha256.

    Texts are equal when all their bytes are; a null text is the empty text. The largest id stays.
    Repeated rows (same id and text) count in group_size and only one of them is kept. A null id
    loses to any other; if every row of a group has a null id, one of them stays with keep_id null.
    An empty table gives an empty result; other columns are ignored whatever their names.
    """
    index = build_index(docs, id_col, text_col, capacity)
    members = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(common.text_of(text_col)).alias("key"), F.sha2(common.text_of(text_col).cast("binary"), 256).alias("text_sha256"))
        .groupBy("key", "text_sha256", "id")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    joined = members.join(index.select("key", "text_sha256", "keep_id", "group_size"), ["key", "text_sha256"])
    each = joined.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy"))
    return each.select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def keep_last(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns; of rows that repeat id and text one stays.

    Input columns travel as one struct, so no name of theirs can clash.
    """
    sha = F.sha2(common.text_of(text_col).cast("binary"), 256)
    mine = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), sha.alias("sha"))
    stay = exact_dedup(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("stay_id"), F.col("text_sha256").alias("stay_sha"))
    # one row of ``stay`` per (id, text); the join leaves rows sorted and dealt out as the window wants them
    kept = mine.join(stay, mine["id"].eqNullSafe(stay["stay_id"]) & (mine["sha"] == stay["stay_sha"])).select("row", "stay_id", "stay_sha")
    first = F.row_number().over(Window.partitionBy("stay_id", "stay_sha").orderBy("stay_sha"))
    return kept.withColumn("place", first).where("place = 1").select("row.*")
