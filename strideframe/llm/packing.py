"""Sequence packing as a cutting-stock problem solved by column generation.

Documents become token ids (byte-level BPE plus id 0); whole sequences of ``capacity`` tokens are
cut off first and the remainders are items of length 1..capacity-1. Their histogram has fewer
rows than ``capacity`` and is all the driver sees. A pattern costs what its sequence takes up: ``capacity``,
or just its own length where that is a power of two. The linear program over patterns is solved by the
simplex method; when no known pattern improves it, its dual prices feed a knapsack dynamic program, whose
table gives the best pattern of every size and the best one around each length; all that improve are added,
until none does. The solution is rounded: patterns are taken as often as their value says and the items
left allow, and what is left is a smaller program, until nothing is. Every pattern copy becomes one
sequence. An item finds its slot from its rank among the items of its length, so no group is ever gathered
in one task.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

CAPACITY = 1024
COLUMNS = 24  # patterns added to the program at a time; the program is solved again until none improves it
_ENCODERS: dict[str, object] = {}


def encoder(json_path: str):
    """text -> ids exactly as the tokenizer file gives them; the same vocabulary as ranks is faster."""
    if json_path not in _ENCODERS:
        import os

        ranks_path = json_path.removesuffix(".json") + ".tiktoken"
        if os.path.exists(ranks_path):
            import tiktoken

            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": 50256})
            _ENCODERS[json_path] = lambda t: enc.encode(t, allowed_special="all")
        else:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(json_path)
            _ENCODERS[json_path] = lambda t: tok.encode(t, add_special_tokens=False).ids
    return _ENCODERS[json_path]


def padded(used: int, capacity: int = CAPACITY) -> int:
    """What a sequence of ``used`` tokens takes up."""
    return used if used & (used - 1) == 0 else capacity


def knapsack(lengths: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """best[c]: greatest value of items that fill exactly c (-inf: none do); last[c]: place of one of its items."""
    best, last = np.full(capacity + 1, -np.inf), np.full(capacity + 1, -1)
    best[0] = 0.0
    fit = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        if n := fit[c]:
            v = best[c - lengths[:n]] + value[:n]
            k = int(v.argmax())
            if v[k] > -np.inf:
                best[c], last[c] = v[k], k
    return best, last


def _traced(last: np.ndarray, lengths: np.ndarray, c: int) -> dict[int, int]:
    out: dict[int, int] = {}
    while c:
        k = int(last[c])
        out[k] = out.get(k, 0) + 1
        c -= int(lengths[k])
    return out


def improving(lengths: np.ndarray, dual: np.ndarray, capacity: int, gap: float) -> list[dict[int, int]]:
    """Patterns (place -> count) worth more at the dual prices than they cost, by the share ``gap``: the best of each size and around each length."""
    use = np.flatnonzero(dual > 1e-12)
    some = lengths[use]
    best, last = knapsack(some, dual[use], capacity)
    sizes = [s for s in (1 << e for e in range(capacity.bit_length())) if s < capacity and best[s] > s * (1 + gap)]
    found = [_traced(last, some, s) for s in sizes]
    upto = np.maximum.accumulate(best)
    at = np.zeros(capacity + 1, dtype=np.int64)  # the fullest filling of that value
    for c in range(1, capacity + 1):
        at[c] = c if best[c] >= upto[c] else at[c - 1]
    around = dual[use] + upto[capacity - some]
    for k in np.argsort(-around, kind="stable")[:COLUMNS]:
        if around[k] <= capacity * (1 + gap):
            break
        pattern = _traced(last, some, int(at[capacity - some[k]]))
        pattern[int(k)] = pattern.get(int(k), 0) + 1
        found.append(pattern)
    return [{int(use[k]): n for k, n in pattern.items()} for pattern in found]


def _greedy(lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {place: count}) of an exhaustive best fit, longest item first."""
    left, out = left.copy(), []
    live = [int(i) for i in np.flatnonzero(left)]
    while live:
        room, pattern = capacity, {}
        for i in reversed(live):
            if lengths[i] <= room and (n := min(int(left[i]), room // int(lengths[i]))):
                pattern[i] = n
                room -= n * int(lengths[i])
        times = max(1, min(int(left[i]) // n for i, n in pattern.items()))
        out.append((times, pattern))
        for i, n in pattern.items():
            left[i] -= times * n
        live = [i for i in live if left[i]]
    return out


def relaxed(lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-3) -> list[tuple[float, dict[int, int]]]:
    """The linear program's solution: [(times, {place: count})], by the revised simplex method with generated columns.

    It ends when no pattern is worth more than its cost by the share ``gap``, or when the value is within that share of the total
    length, which no packing can beat; either proves it to be that near the optimum.
    """
    m = len(lengths)
    basis = [{i: max(1, min(int(demand[i]), capacity // int(k)))} for i, k in enumerate(lengths)]
    weigh = lambda patterns: np.array([padded(int(sum(lengths[i] * n for i, n in p.items())), capacity) for p in patterns], dtype=float)
    rows = np.diag([float(p[i]) for i, p in enumerate(basis)])
    cost, inverse = weigh(basis), np.diag(1.0 / rows.diagonal())
    demand = demand + 1e-6 * np.random.default_rng(0).random(m)  # no two ratios tie, so the simplex method cannot cycle
    x, floor, pivots = inverse @ demand, float(demand @ lengths), 0
    new = [p for _, p in _greedy(lengths, demand.astype(np.int64), capacity)]
    while new:
        before, (table, price) = pivots, (np.zeros((len(new), m)), weigh(new))
        for j, pattern in enumerate(new):
            table[j, list(pattern)] = list(pattern.values())
        while True:
            gain = table @ (cost @ inverse) / price - 1
            j = int(gain.argmax())
            if gain[j] <= gap:
                break
            d = inverse @ table[j]
            up = np.flatnonzero(d > 1e-7)
            ratio = x[up] / d[up]
            tied = up[ratio <= ratio.min() + 1e-9]
            out = tied[d[tied].argmax()]  # the largest pivot keeps the inverse exact
            step = x[out] / d[out]
            x = np.maximum(x - step * d, 0.0)
            x[out] = step
            row = inverse[out] / d[out]
            inverse -= np.outer(d, row)
            inverse[out] = row
            basis[out], cost[out], rows[out] = new[j], price[j], table[j]
            pivots += 1
            if pivots % 256 == 0:
                inverse = np.linalg.inv(rows.T)
                x = np.maximum(inverse @ demand, 0.0)
        if pivots == before or cost @ x <= floor * (1 + gap):
            break
        new = improving(lengths, cost @ inverse, capacity, gap)
    return [(float(v), p) for v, p in zip(x, basis, strict=True) if v > 1e-9]


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """[(times, {length: count})]: patterns that hold every item exactly once.

    Each round takes the patterns of one linear program, the most frequent first, as often as their value rounded to the
    nearest (once at least) and the items left allow; the next program packs what is left. After every round an exhaustive
    best fit of what is left then ends a plan as well; the plan with least padding is returned.
    """
    left = {int(k): int(n) for k, n in histogram.items() if n > 0}
    plan: list[tuple[int, dict[int, int]]] = []
    best, least, gap = plan, float("inf"), 1e-3
    size = lambda p: sum(times * padded(sum(k * n for k, n in named.items()), capacity) for times, named in p)
    while left:
        lengths = np.array(sorted(left))
        for times, pattern in sorted(relaxed(lengths, np.array([left[int(k)] for k in lengths], dtype=float), capacity, gap), key=lambda p: -p[0]):
            named = {int(lengths[i]): n for i, n in pattern.items()}
            use = min(max(round(times), 1), *(left.get(k, 0) // n for k, n in named.items()))
            if use:
                plan.append((use, named))
                for k, n in named.items():
                    left[k] -= use * n
                    if not left[k]:
                        del left[k]
        rest = np.array(sorted(left), dtype=np.int64)
        ended = [*plan, *((t, {int(rest[i]): n for i, n in p.items()}) for t, p in _greedy(rest, np.array([left[int(k)] for k in rest], dtype=np.int64), capacity))]
        if (total := size(ended)) >= least:
            break  # another program no longer helps
        best, least, gap = ended, total, 3e-3
    return best


def _tokenize(json_path: str, capacity: int):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def run(batches):
        encode = encoder(json_path)
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*encode(text), 0], dtype="<u4")
                for at in range(0, len(ids), capacity):
                    piece = ids[at : at + capacity]
                    for col, v in zip(out, (i, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)), strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    return run


def _slots(plan: list[tuple[int, dict[int, int]]], base: int) -> dict[int, dict[str, np.ndarray]]:
    """length -> arrays over its patterns: first rank, items a copy, first sequence id, offset in it."""
    by: dict[int, list] = {}
    seq = base
    for times, pattern in plan:
        at = 0
        for k in sorted(pattern, reverse=True):
            by.setdefault(k, []).append((times * pattern[k], pattern[k], seq, at))
            at += k * pattern[k]
        seq += times
    out = {}
    for k, rows in by.items():
        t = np.array(rows, dtype=np.int64)
        out[k] = {"first": np.concatenate([[0], np.cumsum(t[:, 0])[:-1]]), "each": t[:, 1], "seq": t[:, 2], "at": t[:, 3]}
    return out


def _assign(slots: dict, capacity: int):
    """Rows with the rank of their length -> sequence_id and offset."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("length", "rank"))
            seq, off = rank.copy(), np.zeros(len(rank), np.int64)  # a full piece is its own sequence
            for k in np.unique(length[length < capacity]):
                rows = np.flatnonzero(length == k)
                s = slots[int(k)]
                p = np.searchsorted(s["first"], rank[rows], side="right") - 1
                q = rank[rows] - s["first"][p]
                seq[rows] = s["seq"][p] + q // s["each"][p]
                off[rows] = s["at"][p] + k * (q % s["each"][p])
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in names[:5]), pa.array(seq), pa.array(off)], names=names)

    return run


def pack(docs: DataFrame, json_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is the single id 0, a null id stays null. Repeated rows are packed each. Pieces of one length
    are numbered by the written part they lie in, then by id, start and checksum; pieces equal in all of
    these are interchangeable. An empty table gives an empty result; other columns are ignored.
    """
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_of(text_col).alias("t"))
    pieces = text.mapInArrow(_tokenize(json_path, capacity), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
    pieces = common.save(pieces.withColumn("part", F.spark_partition_id()), "pieces")
    # rank: pieces of that length in the parts before, from one row per part and length, plus the place in the own part
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = common.save(counts.withColumn("before", before), "piece-offsets")
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    full = total.pop(capacity, 0)
    slots = _slots(solve(total, capacity), full)
    place = F.row_number().over(Window.partitionBy("part", "length").orderBy("doc_id", "start", "ids_crc32")) - 1
    ranked = pieces.withColumn("place", place).join(counts.select("part", "length", "before"), ["part", "length"]).withColumn("rank", F.col("before") + F.col("place"))
    return ranked.mapInArrow(_assign(slots, capacity), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long").withColumnRenamed("doc_id", id_col)
