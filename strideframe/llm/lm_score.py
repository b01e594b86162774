"""Language-model scores from a weighted backoff automaton.

The model is an n-gram model (three words, by MASSES) with Dirichlet smoothing: p(w | h) = (c(hw) + m p(w | h')) / (c(h) + m), h' being h
without its first word, down to p(w) = (c(w) + 1/2) / (N + (V + 1) / 2); a text starts after a start mark.
As an automaton: every n-gram seen in training is a state, its arc carries log10 p(w | h), and the failure
arc of a state h, to h', carries log10 m / (c(h) + m). One walk from left to right keeps the state, follows failure arcs until
the next word has an arc, and adds up weights. For a history h the sum of c(hw) over w is c(h), so
the probabilities of all words and of "any other word" sum to 1.

The states of a corpus fit no task, so each block of documents (a few MB of text) gets those its own texts can
reach: it sends its distinct n-grams with their training counts, as sorted hashes cut into buckets of hash ranges, to the buckets,
which add up the counts of all blocks and answer with the totals in the same order. A block then builds its
states, arcs and failure arcs from the totals and walks its documents. Frequent n-grams are summed in the
block before they are sent, so a bucket gets each at most once a block. Equal hashes are taken as equal n-grams: words have
64 bits, longer n-grams as many more than the corpus needs that one meets another's hash with a chance under 2^-``SPARE``.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .jaccard_join import _BYTE, _LOWER, _SPACE, _powers, mix

MASSES = (512.0, 4.0)  # m for histories of 1, 2, .. words: how many observations the shorter history is worth; one more than these is the order
BLOCK_BYTES = 4 << 20  # text of one block; a longer document is a block of its own
BUCKET_BYTES = 1 << 24  # text for which there is one bucket
PIECE = 1 << 20  # bytes hashed at once
_START, _END = np.uint64(0x5BD1E995A5A5A5A5), np.uint64(0x1B873593C3C3C3C3)
SPARE = 24


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word, A-Z lower-cased."""
    out, lo = [], 0
    while lo < len(text):
        hi = lo + PIECE
        if hi < len(text):  # pieces end at a blank
            cut = max(text.rfind(c, lo, hi) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut <= lo:  # one word is longer than a piece
                nexts = [x for x in (text.find(c, hi) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if x >= 0]
                cut = min(nexts, default=len(text))
            hi = cut
        b = _LOWER[np.frombuffer(text, np.uint8, min(hi, len(text)) - lo, lo)]
        inside = np.concatenate([[False], ~_SPACE[b], [False]])
        change = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = change[::2], change[1::2]
        up, down = _powers(len(b) + 1)
        total = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[b] * up[: len(b)])])
        out.append(mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)))
        lo = max(hi, lo + 1)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def held(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def _line(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Start mark, words and end of each text, one after the other; and the places of the start marks."""
    parts, starts, at, joined, sizes = [], [], 0, [], []

    def flush():
        nonlocal at
        if not joined:
            return
        # a short text is hashed with its neighbours; the end of one and the start of the next are found by their byte places
        text = b"\n".join(joined)
        words = word_hashes(text)
        begins = word_starts(text)
        edges = np.cumsum([0, *[s + 1 for s in sizes]])
        counts = np.diff(np.searchsorted(begins, edges))
        line = np.empty(len(words) + 2 * len(sizes), np.uint64)
        first = np.concatenate([[0], np.cumsum(counts + 2)[:-1]])
        mask = np.ones(len(line), bool)
        mask[first] = False
        mask[first + counts + 1] = False
        line[mask] = words
        line[first], line[first + counts + 1] = _START, _END
        parts.append(line)
        starts.append(first + at)
        at += len(line)
        joined.clear()
        sizes.clear()

    held_bytes = 0
    for t in texts:
        if held_bytes + len(t) > PIECE:
            flush()
            held_bytes = 0
        joined.append(t)
        sizes.append(len(t))
        held_bytes += len(t) + 1
    flush()
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.concatenate(starts) if starts else np.zeros(0, np.int64)


def word_starts(text: bytes) -> np.ndarray:
    inside = ~_SPACE[np.frombuffer(text, np.uint8)]
    return np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))


def grams(line: np.ndarray, starts: np.ndarray, order: int) -> list[np.ndarray]:
    """For each length 1..order the hash of the n-gram that ends at each place; 0 where a text has none."""
    place = np.arange(len(line)) - np.repeat(starts, np.diff(np.append(starts, len(line))))
    out, h = [line], mix(line)
    for k in range(2, order + 1):
        h = mix(np.concatenate([np.zeros(1, np.uint64), h[:-1]]) * np.uint64(0xD6E8FEB86659FD93) + line)  # of the k - 1 words before, then this one
        out.append(np.where(place >= k - 1, h, np.uint64(0)))
    return out


def _blocks(batches):
    """Packs documents as blocks, a row each; a null text is empty."""
    number, size, task, ids, texts = 0, 0, None, [], []

    def packed(kind: pa.DataType):
        nonlocal number, size
        row = pa.RecordBatch.from_arrays([pa.array([task + number], pa.int64()), pa.array([size], pa.int64()), pa.array([ids], pa.list_(kind)), pa.array([texts], pa.list_(pa.string()))], names=["block", "bytes", "ids", "texts"])
        number, size = number + 1, 0
        ids.clear()
        texts.clear()
        return row

    for batch in batches:
        if task is None:
            task = TaskContext.get().partitionId() << 32
        for i, t in zip(batch.column(0), batch.column(1), strict=True):
            n = len(t.as_buffer()) if t.is_valid else 0
            if ids and size + n > BLOCK_BYTES:
                yield packed(batch.schema.field(0).type)
            size += n + 64
            ids.append(i.as_py())
            texts.append(t.as_py() if t.is_valid else "")
    if ids:
        yield packed(batch.schema.field(0).type)


def _states(texts: pa.ListScalar, widths: list[int]):
    """The line of a block and its starts, and per n-gram length the hash at each place."""
    line, starts = _line([x.as_buffer().to_pybytes() for x in texts.values])
    return [h >> np.uint64(64 - w) for h, w in zip(grams(line, starts, len(widths)), widths, strict=True)], line, starts


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Rising keys as differences, bytes of equal weight together (the shuffle's compressor removes the zeros), then counts."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes() + _small(counts)


def _small(counts: np.ndarray) -> bytes:
    """Counts as one byte each; those of 255 and more follow with eight."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def _unpacked(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8, 8 * n).reshape(8, n).T).view(np.uint64).ravel()
    return np.cumsum(steps), _counts(data[8 * n :], n)


def _counts(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<i8", -1, n)
    return out


def _send(widths: list[int], buckets: int):
    """The n-grams of the last width's length; bucket k * buckets + b holds those of k + 1 words in the b-th of equal hash ranges."""
    k = len(widths) - 1

    def run(batches):
        for batch in batches:
            for block, ids, texts in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                found, line, starts = _states(texts, widths)
                learns = np.repeat(np.array([not held(i.as_py()) for i in ids.values], dtype=bool), np.diff(np.append(starts, len(line))))
                keys, index = np.unique(found[k], return_inverse=True)
                counts = np.bincount(index[learns], minlength=len(keys))
                bucket = np.floor(keys.astype(np.float64) / 2.0 ** widths[k] * buckets).clip(max=buckets - 1).astype(np.int64)
                edges = np.searchsorted(bucket, np.arange(buckets + 1))
                used = np.flatnonzero(np.diff(edges))
                data = [_packed(keys[edges[b] : edges[b + 1]], counts[edges[b] : edges[b + 1]]) for b in used]
                yield pa.RecordBatch.from_arrays([pa.array([block.as_py()] * len(used), pa.int64()), pa.array(used + k * buckets, pa.int64()), pa.array(np.diff(edges)[used], pa.int64()), pa.array(data, pa.binary())], names=["block", "bucket", "n", "data"])

    return run


def _answer(buckets: int):
    """Totals of a bucket for each block that asked, in its order; and a row with the number and sum of its words."""

    def run(table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_pylist()
        parts = [_unpacked(x.as_buffer().to_pybytes(), n) for x, n in zip(table.column("data"), sizes, strict=True)]
        keys, index = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, index, np.concatenate([c for _, c in parts]))
        edges = np.cumsum([0, *sizes])
        data = [_small(total[index[a:b]]) for a, b in zip(edges, edges[1:], strict=False)]
        bucket = table.column("bucket")[0].as_py()
        words = total[keys != _START] if bucket < buckets else total[:0]
        return pa.table({
            "block": pa.array([*table.column("block").to_pylist(), None], pa.int64()),
            "bucket": pa.array([bucket] * (len(sizes) + 1), pa.int64()),
            "n": pa.array([*sizes, 0], pa.int64()),
            "data": pa.array([*data, None], pa.binary()),
            "words": pa.array([0] * len(sizes) + [int((words > 0).sum())], pa.int64()),
            "tokens": pa.array([0] * len(sizes) + [int(words.sum())], pa.int64()),
        })

    return run


class Automaton:
    """States, arcs and failure arcs for the places of a line; seen[k]: training count of the n-gram of k + 1 words that ends there."""

    def __init__(self, seen: list[np.ndarray], tokens: int, words: int, masses: tuple[float, ...]):
        self.order = len(seen)
        self.base = np.log10((seen[0] + 0.5) / (tokens + 0.5 * (words + 1)))
        p = 10.0**self.base
        self.arcs, self.known, self.fails = [self.base.tolist()], [seen[0] > 0], []
        for k in range(1, self.order):
            mass = masses[k - 1]
            history = np.concatenate([[0], seen[k - 1][:-1]])  # the n-gram of length k that ends one place before
            p = np.where(history > 0, (seen[k] + mass * p) / (history + mass), p)
            self.fails.append(np.where(history > 0, np.log10(mass / (history + mass)), 0.0).tolist())
            self.arcs.append(np.log10(p).tolist())
            self.known.append(seen[k] > 0)
        self.has = [x.tolist() for x in self.known]

    def walk(self, lo: int, hi: int) -> float:
        """Log-probability of the tokens at lo..hi-1 after the start mark at lo - 1. The state is the longest
        known n-gram that ends before the token, named by its length; its failure arc leads to a shorter one."""
        total, top = 0.0, self.order - 1
        state = min(1, top) if self.fails and self.fails[0][lo] < 0 else 0  # the start mark, if training had one
        has, arcs, fails = self.has, self.arcs, self.fails
        for at in range(lo, hi):
            while state and not has[state][at]:
                total += fails[state - 1][at]
                state -= 1
            total += arcs[state][at]
            if state < top:
                state += 1 if state or has[0][at] else 0
        return total


def _score(widths: list[int], buckets: int, tokens: int, words: int, masses: tuple[float, ...]):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        found, line, starts = _states(block.column("texts")[0], widths)
        answers = answers.sort_by("bucket")
        got: list[list[np.ndarray]] = [[] for _ in widths]
        for bucket, n, data in zip(answers.column("bucket").to_pylist(), answers.column("n").to_pylist(), answers.column("data"), strict=True):
            got[bucket // buckets].append(_counts(data.as_buffer().to_pybytes(), n))
        seen = [np.concatenate(x)[np.unique(h, return_inverse=True)[1]] for x, h in zip(got, found, strict=True)]
        place = np.arange(len(line)) - np.repeat(starts, np.diff(np.append(starts, len(line))))
        for k, x in enumerate(seen):
            x[place < k] = 0  # no n-gram ends here
        model = Automaton(seen, tokens, words, masses)
        ends = np.append(starts, len(line))[1:]
        base = [float(model.base[a + 1 : b].sum()) for a, b in zip(starts, ends, strict=True)]
        known = [int(model.known[0][a + 1 : b].sum()) for a, b in zip(starts, ends, strict=True)]
        scores = [model.walk(int(a) + 1, int(b)) for a, b in zip(starts, ends, strict=True)]
        ids = block.column("ids")[0].values
        return pa.table({"id": ids, "held_out": pa.array([held(i) for i in ids.to_pylist()]), "n_tokens": pa.array(ends - starts - 1, pa.int64()), "n_known": pa.array(known, pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(scores, pa.float64())})

    return run


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", masses: tuple[float, ...] = MASSES) -> DataFrame:
    """One row per input row: id_col, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null or empty text is one end. A null id is not held out, so its text trains. Repeated rows repeat and
    train as often; other columns are ignored; an empty table gives an empty result. Without training texts N = V = 0 and
    every token has probability 1. Whole texts are scored; the memory of a task follows its largest document.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    packed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_blocks, f"block long, bytes long, ids array<{kind}>, texts array<string>")
    blocks = common.save(packed, "lm-blocks")
    size = blocks.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first()["n"]
    buckets = max(8, -(-size // BUCKET_BYTES))
    widths = [64, *[min(64, size.bit_length() + SPARE)] * len(masses)]  # there are fewer n-grams of a length than bytes
    answers = None
    for k in range(len(widths), 0, -1):  # one length after the other, so that only one's messages are on disk
        sent = blocks.select("block", "ids", "texts").mapInArrow(_send(widths[:k], buckets), "block long, bucket long, n long, data binary")
        got = common.save(sent.groupBy("bucket").applyInArrow(_answer(buckets), "block long, bucket long, n long, data binary, words long, tokens long"), "lm-answers")
        answers = got if answers is None else answers.unionByName(got)
        del sent, got
        common.release(docs.sparkSession)
    n = answers.where("block IS NULL").agg(F.coalesce(F.sum("words"), F.lit(0)).alias("words"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).first()
    asked = answers.where("block IS NOT NULL").select("block", "bucket", "n", "data")
    scored = blocks.select("block", "ids", "texts").groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(
        _score(widths, buckets, n["tokens"], n["words"], masses), f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(n["tokens"]).cast("long").alias("train_tokens"), "base_score", "score")
