"""Document quality by a linear-chain conditional random field over lines.

Every line has a binary label, good or bad, with features of its own and of its neighbours.
Training takes document labels as the labels of their lines, on at most ``max_docs`` labelled
documents (those with the smallest hash of doc_id: a bounded, documented sample); gradients come
from forward-backward and are summed by the driver over that bounded sample. Scoring runs
forward-backward on every document; its score is the mean of the lines' marginals of "good",
weighted by line length. Neither labels nor ids, source or language are features.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_DOCS = 1000
MAX_LINE = 2000
WORD = re.compile(r"\S+")


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines x features, weights). Lines longer than MAX_LINE are cut in as many lines as needed."""
    lines = [x[i : i + MAX_LINE] for x in text.split("\n") for i in range(0, max(len(x), 1), MAX_LINE)]
    own = np.zeros((len(lines), 10))
    seen: dict[str, int] = {}
    for k, line in enumerate(lines):
        n = len(line)
        words = line.split()
        w = len(words) or 1
        m = max(n, 1)
        upper = sum(map(str.isupper, words))
        letters = sum(map(str.isalpha, words))
        times = seen[line] = seen.get(line, 0) + 1
        odd = n - sum(len(x) for x in re.findall(r"[\w\s.,'-]+", line))
        own[k] = (1, min(n, 400) / 400, len(set(words)) / w, upper / w, letters / w, min(10 * odd / m, 3), min(10 * line.count("|") / w, 3), min(10 * line.count("!") / w, 3), min(times - 1, 3) / 3 if n else 0, n == 0)
    near = np.zeros((len(lines), 16))
    near[:, :10] = own
    near[1:, 10:13] = own[:-1, [2, 3, 5]]
    near[:-1, 13:16] = own[1:, [2, 3, 5]]
    return near, np.array([max(len(x), 1) for x in lines], dtype=float)


def marginals(x: np.ndarray, w: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """P(good) of each line, expected transition counts, log partition function."""
    s = x @ w.T  # lines x 2
    n = len(s)
    e = np.exp(s - s.max(axis=1, keepdims=True))
    t = np.exp(trans)
    f, b = np.empty((n, 2)), np.ones((n, 2))
    logz = float(s.max(axis=1).sum())
    a = e[0]
    for i in range(n):
        if i:
            a = (f[i - 1] @ t) * e[i]
        z = a.sum()
        logz += float(np.log(z))
        f[i] = a / z
    for i in range(n - 2, -1, -1):
        v = t @ (e[i + 1] * b[i + 1])
        b[i] = v / v.sum()
    g = f * b
    g /= g.sum(axis=1, keepdims=True)
    pair = np.zeros((2, 2))
    if n > 1:
        p = f[:-1, :, None] * t[None] * (e[1:] * b[1:])[:, None, :]
        pair = (p / p.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return g[:, 1], pair, logz


def batch_marginals(x: np.ndarray, lengths: np.ndarray, w: np.ndarray, trans: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each line of many documents at once, and transition counts summed with a weight a document.

    x: the documents' lines one after another, longest document first; step i treats line i of all that have one.
    """
    s = x @ w.T
    e = np.exp(s - s.max(axis=1, keepdims=True))
    t = np.exp(trans)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    alive = [int((lengths > i).sum()) for i in range(int(lengths[0]))]
    f, b, pair = np.empty_like(e), np.ones_like(e), np.zeros((2, 2))
    for i, m in enumerate(alive):
        at = starts[:m] + i
        a = e[at] if i == 0 else (f[at - 1] @ t) * e[at]
        f[at] = a / a.sum(axis=1, keepdims=True)
    for i in range(len(alive) - 1, 0, -1):
        at = starts[: alive[i]] + i
        v = (e[at] * b[at]) @ t.T
        b[at - 1] = v / v.sum(axis=1, keepdims=True)
        p = f[at - 1][:, :, None] * t[None] * (e[at] * b[at])[:, None, :]
        pair += (p / p.sum(axis=(1, 2), keepdims=True) * weight[: alive[i], None, None]).sum(axis=0)
    g = f * b
    return g[:, 1] / g.sum(axis=1), pair


def train(docs: list[tuple[str, int]], rounds: int = 40, rate: float = 0.5, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Emission weights (2 x features) and transitions (2 x 2) by batch gradient ascent (Adagrad).

    Classes weigh the same in the sum, however rare one is; a class without rows leaves the prior at 0.5.
    """
    w, trans = np.zeros((2, 16)), np.zeros((2, 2))
    if len({y for _, y in docs}) < 2:
        return w, trans
    data = sorted(((line_features(t)[0], int(y)) for t, y in docs), key=lambda d: -len(d[0]))
    lengths, ys = np.array([len(x) for x, _ in data]), np.array([y for _, y in data])
    share = np.array([0.5 / lengths[ys == y].sum() for y in (0, 1)])
    c = share[ys]
    x, y, line_c = np.concatenate([x for x, _ in data]), np.repeat(ys, lengths), np.repeat(c, lengths)
    stay = np.diag([(c * (lengths - 1))[ys == k].sum() for k in (0, 1)])
    hw, ht = np.full_like(w, 1e-6), np.full_like(trans, 1e-6)
    for _ in range(rounds):
        good, pair = batch_marginals(x, lengths, w, trans, c)
        g = (line_c * (y - good)) @ x
        gw, gt = np.stack([-g, g]) - l2 * w, stay - pair - l2 * trans
        hw += gw * gw
        ht += gt * gt
        w = w + rate * gw / np.sqrt(hw)
        trans = trans + rate * gt / np.sqrt(ht)
    return w, trans


def document_score(text: str, w: np.ndarray, trans: np.ndarray) -> float:
    x, weight = line_features(text)
    good, _, _ = marginals(x, w, trans)
    return float(np.clip((good * weight).sum() / weight.sum(), 0, 1))


def _score(w: np.ndarray, trans: np.ndarray):
    def run(batches):
        for batch in batches:
            got = [document_score(t or "", w, trans) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], names=["id", "score"])

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_docs: int = MAX_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """Learn from the whole texts of labelled rows with crc32(id) mod 5 <> 0: max_docs/2 of each label, smallest hashes first.

    An id whose labels disagree is left out; of several texts under one id the first in byte order counts.
    """
    rows = labels.where(F.col("quality").isin(0, 1) & F.col(id_col).isNotNull() & (F.crc32(F.col(id_col).cast("string")) % 5 != 0))
    good = rows.groupBy(F.col(id_col).alias("id")).agg(F.min("quality").alias("y"), F.max("quality").alias("other")).where("y = other")
    halves = [good.where(F.col("y") == y).select("id", "y").orderBy(F.xxhash64("id"), "id").limit(max_docs // 2) for y in (0, 1)]
    picked = F.broadcast(halves[0].unionByName(halves[1]))  # at most max_docs rows
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).join(picked, "id")
    found = texts.groupBy("id").agg(F.min("t").alias("t"), F.first("y").alias("y")).orderBy("id").collect()
    return train([(r["t"], r["y"]) for r in found])


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per input row: id_col, held_out, score, predicted.

    A null or empty text is one empty line and gets a score too; a null id is never held out. Without labels of both kinds every
    score is 0.5. Repeated rows repeat; an empty table gives an empty result; other columns are ignored.
    """
    w, trans = fit(docs, labels, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(_score(w, trans), f"id {kind}, score double")
    return scored.select(F.col("id").alias(id_col), F.coalesce(F.crc32(F.col("id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, training: DataFrame | None = None) -> DataFrame:
    """The rows of docs that the classifier does not reject, with all their columns, in one pass; training: where to learn, else docs."""
    w, trans = fit(docs if training is None else training, labels, id_col, text_col)

    def run(batches):
        for batch in batches:
            keep = [document_score(t or "", w, trans) >= threshold for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
