"""Removal of repeated byte strings by distributed prefix doubling over sampled positions.

Every window of ``length`` bytes names one position in it: the leftmost smallest hash of its
``seed``-byte strings (length - seed + 1 of them, so equal windows name equal positions). The rank of
a position starts as that of its seed string. Each round halves a position's cell of window starts, so the
string that all windows of the cell share grows by half the cell on one side (73, 137, 169, 185, 193, 197,
199, 200 bytes) and its rank becomes that of the pair (rank, bytes it grew by); only the bytes that the
string has not reached yet travel on. Positions whose rank is unique are dropped; a class all of whose
members have one and the same neighbourhood is decided at once, and of equal neighbourhoods one goes on
for all. At the threshold what is left repeats.

The first round needs no bytes: the scan names each seed string and each neighbourhood by 64 bits, and two
neighbourhoods are the same where both names are. Later ranks are 128-bit names, and neighbourhoods in a rank
64-bit ones, given alike in every task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LENGTH, SEED = 200, 73
CELLS = LENGTH - SEED + 1
_TABLE = np.random.default_rng(19990731).integers(1, 1 << 63, 256, dtype=np.uint64)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
CHUNK = 1 << 15  # window starts hashed at once, so that the arrays stay in the cache
GROUP = 1 << 22
HOT_CLASSES = 2_000


def _mixed(x: np.ndarray, y: np.ndarray, shift: int = 29) -> np.ndarray:
    x = x * _M1
    x += y
    x ^= x >> np.uint64(shift)
    x *= _M2
    return x


def _hashes(b: np.ndarray):
    """64-bit hashes of every SEED-byte and every 64-byte string, by doubling 1, 2, 4 .. 64 and 64 + 8 + 1."""
    one = h = _TABLE[b]
    n = 1
    while n < 64:
        h = _mixed(h[:-n], h[n:])
        n *= 2
        if n == 8:
            eight = h
    m = len(b) - SEED + 1
    x = _mixed(h[:m], eight[64 : 64 + m], 31)
    x += one[72 : 72 + m]
    x ^= x >> np.uint64(32)
    return x, h


def anchors(b: np.ndarray, ends: np.ndarray):
    """(position, first window start, last window start, seed hash, neighbourhood hash) of every named position.

    b holds whole documents that end at ``ends``; windows do not cross these.
    """
    out = []
    starts = np.concatenate([[0], ends[:-1]])
    breaks = np.sort(np.concatenate([starts, np.maximum(ends - LENGTH + 1, starts)]))
    for lo in range(0, len(b) - LENGTH + 1, CHUNK):
        x, h = _hashes(b[lo : lo + CHUNK + LENGTH - 1])
        seed = x
        x = (x & ~np.uint64(0xFFFFF)) | np.arange(len(x), dtype=np.uint64)
        n = 1
        while n < CELLS:
            x = np.minimum(x[: len(x) - n], x[n:])
            n *= 2
        at = (x & np.uint64(0xFFFFF)).view(np.int64)
        new = np.empty(len(at), bool)
        new[0] = True
        np.not_equal(at[1:], at[:-1], out=new[1:])
        new[breaks[np.searchsorted(breaks, lo) : np.searchsorted(breaks, lo + len(at))] - lo] = True
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:] - 1, [len(at) - 1]])
        fits = first + lo + LENGTH <= ends[np.searchsorted(ends, first + lo, "right")]
        first, last = first[fits], last[fits]
        tail = [_mixed(h[p], h[p + 64]) for p in (first, first + LENGTH - 128, last + LENGTH - 128)]
        out.append((at[first] + lo, first + lo, last + lo, seed[at[first]].view(np.int64), *tail))
    if not out:
        return [np.zeros(0, np.int64)] * 5
    pos, first, last, seed, *part = (np.concatenate(c) for c in zip(*out, strict=True))
    # a position on both sides of a chunk's end is one
    joined = np.concatenate([[False], (pos[1:] == pos[:-1]) & (first[1:] == last[:-1] + 1)])
    head, tail = np.flatnonzero(~joined), np.flatnonzero(~np.concatenate([joined[1:], [False]])[: len(joined)])
    pos, first, last, seed = pos[head], first[head], last[tail], seed[head]
    # three strings of 128 bytes cover all windows
    shape = ((pos - first) * 256 + (pos - last)).astype(np.uint64)
    name = _mixed(_mixed(_mixed(part[0][head], part[1][head]), part[2][tail], 31), shape)
    name ^= name >> np.uint64(32)
    return pos, first, last, seed, name.view(np.int64)


def _flat(column: pa.Array):
    """Bytes of a binary column, and its length + 1 offsets in them."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), at


def _scan(batches):
    for batch in batches:
        rows = batch.column(0).to_numpy()
        b, at = _flat(batch.column(1))
        i = 0
        while i < len(rows):
            j = max(i + 1, int(np.searchsorted(at, at[i] + GROUP, "right")) - 1)
            ends = at[i + 1 : j + 1] - at[i]
            pos, lo, hi, seed, name = anchors(b[at[i] : at[j]], ends)
            doc = np.searchsorted(ends, lo, "right")
            begin = (at[i:j] - at[i])[doc]
            made = [rows[i:j][doc], (pos - begin).astype(np.int32), (pos - hi).astype(np.int16), (pos - lo).astype(np.int16), seed, name]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], names=["row", "pos", "u", "v", "rank", "w"])
            i = j


def _neighbourhoods(batches):
    """Rows with a document and some of its anchors -> one row each with the bytes around it.

    Repeats of a row meet in one task; the first is enough.
    """
    seen = set()
    for batch in batches:
        rows, counts = batch.column(0).to_pylist(), batch.column(2).value_lengths().to_numpy()
        b, at = _flat(batch.column(1))
        fresh = np.array([not (r in seen or seen.add(r)) for r in rows], bool)
        doc = np.repeat(np.arange(len(rows)), counts)
        keep = np.flatnonzero(fresh[doc])
        doc, places = doc[keep], batch.column(2).flatten().take(pa.array(keep))
        pos, u, v, done = (places.field(c) for c in range(4))
        anchor = at[doc] + pos.to_numpy()
        text = memoryview(b)
        for i in range(0, len(keep), 4096):
            part = slice(i, i + 4096)
            begin, end = anchor[part] - v[part].to_numpy(), anchor[part] - u[part].to_numpy() + LENGTH
            ctx = pa.array([text[x:y].tobytes() for x, y in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.asarray(rows)[doc[part]]), pos[part], u[part], v[part], done[part], ctx], names=["row", "pos", "u", "v", "done", "ctx"])


def _with_text(rows: DataFrame, places: DataFrame) -> DataFrame:
    """places(row, pos, u, v, done) with r1, r2, the rank of the seed string, and the bytes left and right of it.

    u..v are the window starts, counted back from the anchor.
    """
    held = places.groupBy("row").agg(F.collect_set(F.struct("pos", "u", "v", "done")).alias("places"))
    near = rows.join(held, "row").select("row", "body", "places").mapInArrow(_neighbourhoods, "row long, pos int, u short, v short, done boolean, ctx binary")
    core = F.expr(f"substring(ctx, v + 1, {SEED})")
    return near.select(
        "row", "pos", "u", "v", "done", F.lit(0).alias("cell"), F.xxhash64(F.lit(1), core).alias("r1"), F.xxhash64(core, F.lit(2)).alias("r2"),
        F.expr("substring(ctx, 1, v)").alias("left"), F.expr(f"substring(ctx, v + {SEED + 1}, {CELLS - 1} - u)").alias("right"),
    )


def _halved(one: DataFrame, size: int) -> DataFrame:
    """Both halves of each cell of ``size`` window starts, ranked, with w naming what their windows hold besides.

    The string that a cell's windows share is text[anchor - cell, anchor - cell - size + 1 + LENGTH). The
    half at ``cell`` grows it to the right, the other to the left; a segment that covers part of a half still
    holds its string, as windows in it contain it.
    """
    half = size // 2
    both = one.withColumn("at", F.explode(F.array(F.col("cell"), F.col("cell") + half)))
    both = both.withColumn("nu", F.expr("greatest(CAST(u AS int), at)")).withColumn("nv", F.expr(f"least(CAST(v AS int), at + {half - 1})")).where("nu <= nv")
    grown = F.expr(f"IF(at = cell, substring(right, 1, {half}), substring(left, v - cell - {half - 1}, {half}))")
    kids = both.select(
        "row", "pos", F.expr("CAST(nu AS short)").alias("u"), F.expr("CAST(nv AS short)").alias("v"), "done", F.col("at").alias("cell"),
        F.xxhash64(F.col("at"), F.col("r1"), F.col("r2"), grown).alias("r1"), F.xxhash64(grown, F.col("r2"), F.col("r1"), F.col("at")).alias("r2"),
        F.expr("substring(left, v - nv + 1, nv - at)").alias("left"), F.expr(f"substring(right, cell + {half} - at + 1, at + {half - 1} - nu)").alias("right"),
    )
    return kids.withColumn("w", F.xxhash64("u", "v", "left", "right"))


def _looked_up(rows: DataFrame, classes: DataFrame, on: list[str], size: str) -> DataFrame:
    """rows joined with the table of their classes, of which ``size`` counts the rows.

    A class of more than one in HOT_CLASSES rows would fill a task; there are fewer than HOT_CLASSES
    such classes whatever the input, so these are broadcast and only the others are shuffled.
    """
    hot = F.col(size) * HOT_CLASSES > rows.count()
    if not classes.where(hot).limit(1).count():
        return rows.join(classes.hint("shuffle_hash"), on)
    large = F.broadcast(classes.where(hot))
    others = rows.join(large.select(*on), on, "left_anti").join(classes.where(~hot).hint("shuffle_hash"), on)
    return rows.join(large, on).unionByName(others)


def _cut_kind(batches):
    """Documents with their repeated window starts -> what is left of them."""
    for batch in batches:
        b, at = _flat(batch.column(1))
        spans = batch.column(2)
        doc = np.repeat(np.arange(len(batch)), spans.value_lengths().fill_null(0).to_numpy())
        both = spans.flatten().to_numpy()
        f, t = (both >> 32) + at[doc], (both & 0xFFFFFFFF) + at[doc]
        order = np.argsort(f, kind="stable")  # documents lie one after the other, so this sorts by document
        doc, f, t = doc[order], f[order], np.maximum.accumulate(t[order])
        new = np.ones(len(f), bool)
        new[1:] = (f[1:] > t[:-1]) | (doc[1:] != doc[:-1])
        head = np.flatnonzero(new)
        doc, f, t = doc[head], f[head], t[np.concatenate([head[1:] - 1, [len(t) - 1]])] if len(head) else t
        n_spans = np.bincount(doc, minlength=len(batch)).astype(np.int64)
        n_removed = np.bincount(doc, t - f, len(batch)).astype(np.int64)
        text, shas, k, f, t = memoryview(b), [], 0, f.tolist(), t.tolist()
        for begin, end, n in zip(at[:-1].tolist(), at[1:].tolist(), n_spans.tolist(), strict=True):
            sha = hashlib.sha256()
            for i in range(k, k + n):
                sha.update(text[begin : f[i]])
                begin = t[i]
            sha.update(text[begin:end])
            shas.append(sha.hexdigest())
            k += n
        made = [batch.column(0), pa.array(np.diff(at)), pa.array(n_removed), pa.array(n_spans), pa.array(shas, pa.string())]
        yield pa.RecordBatch.from_arrays(made, names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _decided(live: DataFrame, rank: list[str], size: int):
    """One round over live(row, pos, u, v, done, w and a rank): the repeated spans, and the positions that go on.

    The latter is None at the last round, and None is left of live.
    """
    spark = live.sparkSession
    common.release(spark)
    ranks = common.save(live.groupBy(*rank).agg(F.count(F.lit(1)).alias("n"), (F.min("w") != F.max("w")).alias("several")).where("n > 1"), "ranks")
    common.release(spark)
    shared = common.save(_looked_up(live, ranks, rank, "n").drop("n"), "shared-ranks")
    common.forget(live, ranks)
    span = ["row", (F.col("pos") - F.col("v")).alias("f"), (F.col("pos") - F.col("u") + LENGTH).alias("t")]
    # done: this neighbourhood has a twin already
    alike = shared.where("NOT several AND NOT done").select(*span)
    if size == 1:
        return common.save(alike, "repeated"), None
    # of each neighbourhood one position goes on, if another neighbourhood shares its rank
    open_ones, key = shared.where("several").drop("several").withColumn("place", F.xxhash64("row", "pos")), [*rank, "w"]
    classes = common.save(open_ones.groupBy(*key).agg(F.count(F.lit(1)).alias("same"), F.min("place").alias("first_place")), "classes")
    common.release(spark)
    known = common.save(_looked_up(open_ones, classes, key, "same"), "known")
    found = common.save(alike.unionByName(known.where("same > 1 AND NOT done").select(*span)), "repeated")
    common.forget(shared, classes)
    return found, known


def repeated_spans(rows: DataFrame) -> DataFrame:
    """row, f, t (byte ranges, t exclusive) of all repeated windows of rows(row long, body binary)."""
    named = rows.mapInArrow(_scan, "row long, pos int, u short, v short, rank long, w long")
    live, rank, size, found = common.save(named.withColumn("done", F.lit(False)), "anchors"), ["rank"], CELLS, []
    while True:
        spans, known = _decided(live, rank, size)
        found.append(spans)
        if known is None:
            break
        one = known.where("place = first_place").withColumn("done", F.col("done") | (F.col("same") > 1))
        if size == CELLS:
            one = _with_text(rows, one)
        common.release(rows.sparkSession)
        live = common.save(_halved(one, size), "ranked")
        common.forget(known)
        del known, one
        rank, size = ["r1", "r2"], size // 2
        if not live.limit(1).count():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, n_bytes, n_removed, n_spans, kept_sha256.

    A null text is empty; texts under LENGTH bytes lose nothing; a repeated row is a repeat of its
    twin and loses all its windows, and its anchors are looked up once however often it repeats. An empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), common.text_of(text_col)).alias("row"), common.text_of(text_col).cast("binary").alias("body"))
    span = F.expr("shiftleft(CAST(f AS long), 32) | t")
    spans = repeated_spans(rows.select("row", "body")).groupBy("row").agg(F.collect_set(span).alias("spans"))
    left = rows.join(spans, "row", "left")
    made = left.select("id", "body", "spans").mapInArrow(_cut_kind, f"id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return made.withColumnRenamed("id", id_col)
