"""Repair of conversation structure by cost layers over the grammar (s?(ua)+)?.

A turn is kept (0), given the other role (3), deleted (4; required for blank and repeated turns), or an empty turn
is inserted (3); a truncated turn that stays costs 3 more. The grammar's automaton has four states: nothing yet, after
s, after u, after a; the first and the last accept. From the last turn to the first, every place holds the
layers of rising cost, each a bitset of the states from which the rest can be completed at that cost; all layers of a
place are one machine word (four bits a layer), so an edit is a mask, a shift by its cost and a move of bits. The states' costs at a
place differ by at most ``SPREAD`` (a start from nothing can be imitated from any state by one insertion
and one deletion), so the layers above that hold no state that a lower one lacks and the word stays short. The first layer
with the start state is the least cost. A walk from it takes at each place the least letter whose bit
is set in the layer that the edit leaves, which is the least of the cheapest audits.

Spark damages and judges the rows, finds repeats by an aggregate of first places, deals the turns by ranges of
(conversation, turn), so that a long conversation spreads over tasks, and packs each stretch to one byte a
turn. Only these bytes of a conversation that crosses a range meet in one task; its audit, one cell, is as long. SHA-256 is
sequential, so a conversation's repaired text streams through one task in batches.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

BLANKS = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPREAD = REROLE + INSERT + DELETE
STRETCH = 1 << 14  # turns packed in one row, and between two places whose words are kept

_ROWS = (1 << 4 * (SPREAD + max(DELETE, REROLE + TRUNCATED, INSERT) + INSERT + 1)) - 1
_ALL = (1 << 4 * (SPREAD + 1)) - 1
_UNIT = int("1" * (SPREAD + 16), 16)  # state 0 in every layer
_AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}  # automaton: letter -> state -> state
_NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}  # the only letter that an inserted or reroled turn can be
INITIALS, FAULTS = "sua?", ("", "drop", "cut")


def _before(word: int, letters: str) -> int:
    """In every layer, the states from which one of the letters leads into a state of that layer."""
    out = 0
    for letter in letters:
        for state, after in _AFTER[letter].items():
            out |= ((word >> after) & _UNIT) << state
    return out


def _with_insertions(word: int) -> int:
    """Layers closed under insertion of a turn; two in a row reach every state an insertion can."""
    for _ in range(2):
        word |= _before(word, "ua") << 4 * INSERT
    return word & _ROWS


def _lowered(base: int, word: int) -> tuple[int, int]:
    """The word with its lowest layer that holds a state first, and without layers that cannot matter."""
    while not word & 15:
        word, base = word >> 4, base + 1
    return base, word & _ALL


def _step(base: int, word: int, code: int) -> tuple[int, int]:
    """The layers in front of a turn from those behind it. code: initial + 4 * fault."""
    initial, fault = INITIALS[code & 3], code >> 2
    made = word << 4 * DELETE
    if fault != 1:
        extra = TRUNCATED * (fault == 2)
        made |= _before(word, "ua") << 4 * (REROLE + extra)
        if initial != "?":
            made |= _before(word, initial) << 4 * (KEEP + extra)
    return _lowered(base, _with_insertions(made))


END = _lowered(0, _with_insertions(0b1001))


def least_edits(codes: bytes) -> tuple[int, str]:
    """Least cost and the ASCII-least of its audits for one conversation's turns (a byte each).

    Words are kept at the ends of stretches only, and made again stretch by stretch for the walk.
    """
    ends, place = [END], END
    for at in range(len(codes), 0, -STRETCH):
        for code in reversed(codes[max(0, at - STRETCH) : at]):
            place = _step(*place, code)
        ends.append(place)
    base, word = ends.pop()
    cost = rest = next(base + c for c in range(word.bit_length() // 4 + 1) if word >> 4 * c & 1)

    def has(place: tuple[int, int], state: int, left: int) -> bool:
        return left >= place[0] and bool(place[1] >> 4 * (left - place[0]) + state & 1)

    audit, state = [], 0
    first = len(codes) % STRETCH or STRETCH
    cuts = [0, *range(first, len(codes), STRETCH), len(codes)] if codes else [0]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        places = [ends.pop()]
        for code in reversed(codes[lo:hi]):
            places.append(_step(*places[-1], code))
        places.reverse()
        for at in range(hi - lo):
            here, there, code = places[at], places[at + 1], codes[lo + at]
            initial, fault = INITIALS[code & 3], code >> 2
            extra = TRUNCATED * (fault == 2)
            while True:
                grown = _AFTER[_NEXT[state]][state]
                if has(there, state, rest - DELETE):
                    audit.append("D")
                    rest -= DELETE
                elif has(here, grown, rest - INSERT):
                    audit.append("I")
                    rest, state = rest - INSERT, grown
                    continue
                elif fault != 1 and state in _AFTER.get(initial, ()) and has(there, _AFTER[initial][state], rest - KEEP - extra):
                    audit.append("K")
                    rest, state = rest - KEEP - extra, _AFTER[initial][state]
                else:
                    audit.append("R")
                    rest, state = rest - REROLE - extra, grown
                break
    while rest:
        audit.append("I")
        rest, state = rest - INSERT, _AFTER[_NEXT[state]][state]
    return cost, "".join(audit)


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text after the damage. Nulls read as one space."""

    def told(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    what = F.crc32(F.concat(told(conv), F.lit(":"), told(turn))) % 20
    rows = conversations.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), told(role).alias("role"), told(text).alias("text"), what.alias("what"))
    changed = F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    spoken = F.when(F.col("what") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("what <> 0").select("conv", "turn", spoken.alias("role"), changed.alias("text"), F.explode(copies).alias("copy")).drop("copy")


ORDER = ("turn", "role", "digest", "id")


def judged(turns: DataFrame) -> DataFrame:
    """Fault of each turn (0 none, 1 blank or repeated, 2 truncated) and which, without its text. turns: a written table with id and digest."""
    end = F.rtrim("text", F.lit(BLANKS))
    light = turns.select("conv", *ORDER, (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("open"))
    place = F.struct(F.col("turn").isNotNull().alias("there"), *ORDER)
    again = light.groupBy("conv", "digest").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    again = again.select(F.col("conv").alias("c"), F.col("digest").alias("g"), F.col("first.id").alias("first"))
    known = light.join(again, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("g")), "left")
    return known.select(
        "conv", *ORDER, F.left("role", F.lit(1)).alias("initial"), F.when(F.col("blank"), 1).when(F.col("first") != F.col("id"), 2).when(F.col("open"), 3).otherwise(0).alias("fault")
    )


_STRETCH_FIELDS = "turn long, role string, digest binary, id long, begins boolean, ends boolean, codes binary, blank long, duplicate long, truncated long, illegal long, opening string, closing string, places long, low long, high long"


def _stretches(batches):
    """Rows of one sorted range as stretches of a conversation, a row each."""
    held: dict | None = None
    first, out = True, []

    def close(ends: bool):
        held["ends"] = ends
        held["codes"] = bytes(held["codes"])
        out.append(held)

    for batch in batches:
        for conv, turn, role, digest, i, initial, fault in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held is None or held["conv"] != conv or len(held["codes"]) >= STRETCH:
                same = held is not None and held["conv"] == conv
                if held is not None:
                    close(not same)
                held = dict(conv=conv, turn=turn, role=role, digest=digest, id=i, begins=not first and not same, codes=bytearray(), blank=0, duplicate=0, truncated=0, illegal=0, opening=initial, closing=None, places=0, low=None, high=None)
                first = False
            elif held["closing"] + initial not in ("su", "ua", "au"):
                held["illegal"] += 1
            held["codes"].append(max(INITIALS.find(initial), 0) % 4 + 4 * (0, 1, 1, 2)[fault] if initial and initial in "sua" else 3 + 4 * (0, 1, 1, 2)[fault])
            if fault:
                held[(None, "blank", "duplicate", "truncated")[fault]] += 1
            held["closing"] = initial
            if turn is not None and turn != held["high"]:
                held["places"] += 1
                held["low"] = turn if held["low"] is None else held["low"]
                held["high"] = turn
        if len(out) >= 1 << 10:
            yield _batch(out, batch.schema.field(0).type)
            out.clear()
    if held is not None:
        close(False)
    if out:
        yield _batch(out, batch.schema.field(0).type)


_LONGS = ("turn", "id", "blank", "duplicate", "truncated", "illegal", "places", "low", "high")


def _batch(rows: list[dict], conv: pa.DataType) -> pa.RecordBatch:
    kinds = {"conv": conv, "role": pa.string(), "digest": pa.binary(), "begins": pa.bool_(), "ends": pa.bool_(), "codes": pa.binary(), "opening": pa.string(), "closing": pa.string()} | dict.fromkeys(_LONGS, pa.int64())
    return pa.RecordBatch.from_pydict({k: pa.array([r[k] for r in rows], kinds.get(k)) for k in ("conv", "turn", "role", "digest", "id", "begins", "ends", "codes", "blank", "duplicate", "truncated", "illegal", "opening", "closing", "places", "low", "high")})


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _report(parts) -> dict:
    """One conversation from its stretches in order."""
    codes, out, last = [], dict(blank=0, duplicate=0, truncated=0, illegal=0), None
    places, low, high = 0, None, None
    for p in parts:
        codes.append(p["codes"])
        for k in out:
            out[k] += p[k]
        if last is not None and last + p["opening"] not in ("su", "ua", "au"):
            out["illegal"] += 1
        last = p["closing"]
        if p["low"] is not None:
            places += p["places"] - (p["low"] == high)
            low, high = p["low"] if low is None else low, p["high"]
    cost, audit = least_edits(b"".join(codes))
    return out | {"gaps": 0 if low is None else high - low + 1 - places, "cost": cost, "audit": audit}


_REPORT_NAMES = [x.split()[0] for x in _REPORT.split(", ")]


def _whole(batches):
    for batch in batches:
        got = [_report([p]) for p in batch.select(batch.schema.names[1:]).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([g[k] for g in got], pa.string() if k == "audit" else pa.int64()) for k in _REPORT_NAMES]], names=["conv", *_REPORT_NAMES])


def _crossing(table: pa.Table) -> pa.Table:
    table = table.sort_by("rank")
    got = _report(p for batch in table.to_batches() for p in batch.to_pylist())
    return pa.table({"conv": table.column("conv")[:1].combine_chunks(), **{k: pa.array([got[k]], pa.string() if k == "audit" else pa.int64()) for k in _REPORT_NAMES}})


def _hashes(batches):
    """Sorted rows of whole conversations: first the audit, then its turns. One row (conv, sha) at each end."""
    none = object()
    conv, audit, at, state, sha, count = none, "", 0, 0, None, 0
    out: list[tuple] = []

    def put(role: str, text: str):
        nonlocal count
        sha.update((("\n" if count else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        count += 1

    def insertions():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            put("user" if _NEXT[state] == "u" else "assistant", "")
            state, at = _AFTER[_NEXT[state]][state], at + 1

    def close():
        if conv is not none:
            insertions()
            out.append((conv, sha.hexdigest()))

    for batch in batches:
        for c, told, role, text in zip(*[x.to_pylist() for x in batch.columns], strict=True):
            if told is not None:
                close()
                conv, audit, at, state, sha, count = c, told, 0, 0, hashlib.sha256(), 0
                continue
            insertions()
            edit = audit[at]
            at += 1
            if edit == "K":
                put(role, text)
                state = _AFTER[role[0]][state]
            elif edit == "R":
                put("user" if _NEXT[state] == "u" else "assistant", text)
                state = _AFTER[_NEXT[state]][state]
        if len(out) >= 1 << 12:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], batch.schema.field(0).type), pa.array([x[1] for x in out])], names=["conv", "repaired_sha256"])
            out.clear()
    close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], batch.schema.field(0).type), pa.array([x[1] for x in out])], names=["conv", "repaired_sha256"])


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation id (a null id is one too): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are damaged first (see damage()). Turns stand by turn, nulls first; equal turns by role, then by the
    text's SHA-256. Only a role's first letter counts for the grammar, and letters other than s, u, a never fit; an
    empty role has none. Texts are taken whole. Conversations without rows after damage have zeros, an empty audit and the hash of the
    empty string. Other columns are ignored; an empty table gives an empty result.
    """
    kind = conversations.schema[conv].dataType.simpleString()
    everyone = conversations.select(F.col(conv).alias("conv")).distinct()
    damaged = damage(conversations, conv, turn, role, text).withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    turns = common.save(damaged.withColumn("id", F.monotonically_increasing_id()), "turns")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), "role", "digest", "id"]
    dealt = judged(turns).repartitionByRange(*order).sortWithinPartitions(*order).select("conv", *ORDER, "initial", "fault")
    stretches = common.save(dealt.mapInArrow(_stretches, f"conv {kind}, {_STRETCH_FIELDS}"), "stretches")
    whole = stretches.where("begins AND ends").drop("turn", "role", "digest", "id").mapInArrow(_whole, f"conv {kind}, {_REPORT}")
    # those at the edges of a range; where the conversation lies in this range alone there is one stretch
    place = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "digest", "id")
    edges = stretches.where("NOT (begins AND ends)").withColumn("rank", F.row_number().over(place)).drop("turn", "role", "digest", "id")
    reports = common.save(whole.unionByName(edges.groupBy("conv").applyInArrow(_crossing, f"conv {kind}, {_REPORT}")), "reports")
    stream = reports.select("conv", "audit", *[F.lit(None).cast(t).alias(c) for c, t in (("turn", turns.schema["turn"].dataType), ("role", "string"), ("digest", "binary"), ("id", "long"), ("text", "string"))])
    stream = stream.unionByName(turns.withColumn("audit", F.lit(None).cast("string")))
    stream = stream.repartition("conv").sortWithinPartitions("conv", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "digest", "id")
    hashes = stream.select("conv", "audit", "role", "text").mapInArrow(_hashes, f"conv {kind}, repaired_sha256 string")
    told = reports.join(hashes.withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c"))).drop("c").withColumnRenamed("conv", "c")
    out = everyone.join(told, F.col("conv").eqNullSafe(F.col("c")), "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(F.col("conv").alias(conv), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
