"""Jaccard join of documents on word-shingle sets, and its components.

Sets are 64-bit shingle hashes; equal sets are one node (``key``). Two sets with Jaccard >= t share
an element among their first |s| - ceil(t|s|) + 1 elements in any one order; the order here puts
shingles that many documents share last, so a common passage is rarely indexed. Nodes that share
such an element lie in one tile, sorted by size. A tile of over ``block`` nodes is cut into size bands
(partners differ by at most the factor t, so they lie in the same or the next band) and each band
into blocks by key; a task compares one pair of blocks.

Inside its task a pair is bounded from above by the places of the shared element in both sets and by
the parity bitmaps (overlap <= (|A| + |B| - differing bits) / 2). No pair becomes a row before it has
passed both. Of the pairs that pass, every node sends on its ``best`` most alike ones outside its own
component (first of a tile, then of all its tiles); their sorted arrays are intersected exactly,
links contract components, and tiles with pairs held back are compared again with four times as many,
until none is held back. So no link is lost, while a huge group of mutual copies never becomes all
its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE, _BASE_INV = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POW: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
HEAVY = 1 << 16
YIELD = 1 << 17
NEAR = 8  # rows of a small tile are compared by their distance in the sorted table, all tiles at once
HOT = 1 << 12  # elements in so many sets are dealt out by key as well


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW["up"]) < n:
        m = 1 << n.bit_length()
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            _POW[name] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(m, base, np.uint64))])
    return _POW["up"][:n], _POW["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; fewer words than that are one shingle."""
    b = _LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    if not len(b):
        return np.zeros(0, np.uint64)
    inside = np.concatenate([[False], ~_SPACE[b], [False]])
    change = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = change[::2], change[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(b) + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[b] * up[: len(b)])])
    h = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    n = len(h)
    k = min(words, n)
    s = np.full(n - k + 1, np.uint64(k))
    for i in range(k):
        s = mix(s * np.uint64(0xD6E8FEB86659FD93) + h[i : n - k + 1 + i])
    return np.unique(s)


def bitmap(s: np.ndarray) -> bytes:
    """Parity bits of the element hashes, as many as the next power of two from the set's size, 512 at least."""
    size = max(512, 1 << max(len(s) - 1, 0).bit_length())
    return np.packbits(np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size).astype(np.uint8) & 1).tobytes()


def _key(s: np.ndarray) -> int:
    if not len(s):
        return 0
    return int(mix(np.array([np.bitwise_xor.reduce(mix(s)) ^ np.uint64(len(s)), s.sum(dtype=np.uint64)], np.uint64)).view(np.int64).sum())


def _texts(column: pa.Array):
    """The texts of a batch one at a time, so that a batch of long ones is never held as strings too."""
    return (x.as_py() or "" for x in column)


def _sets(words: int):
    """id, n, key, bits of each row; then one row with the part's frequent hash buckets in ``counts``."""
    names = ["id", "n", "key", "bits", "counts"]

    def run(batches):
        docs, counts = 0, np.zeros(1 << 20, np.int64)
        for batch in batches:
            ns, keys, bits = [], [], []
            docs += batch.num_rows
            for t in _texts(batch.column(1)):
                s = shingles(t, words)
                ns.append(len(s))
                keys.append(_key(s))
                bits.append(bitmap(s))
                np.add.at(counts, (s >> np.uint64(44)).astype(np.int64), 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ns, pa.int64()), pa.array(keys, pa.int64()), pa.array(bits, pa.binary()), pa.nulls(batch.num_rows, pa.binary())], names=names)
        places = np.flatnonzero(counts >= max(16, docs // 50) + 4 * counts.mean())
        if len(places):
            packed = np.stack([places, counts[places]], 1).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.nulls(1, batch.schema.field(0).type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([packed], pa.binary())], names=names)

    return run


def _buckets(batches):
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            pairs = np.frombuffer(packed, "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["bucket", "n"])


def _prefixes(words: int, percent: int, heavy: dict[int, int]):
    """Postings (token, salt, n, pos, key): the first elements of each set with their places.

    salt is -1, or for elements in hot buckets a number by key, so that no task gets all their rows.
    """
    places = np.array(sorted(heavy), dtype=np.int64)
    weight = np.array([heavy[int(k)] for k in places], dtype=np.int64)

    def run(batches):
        def made(*columns):
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in columns], names=["token", "salt", "n", "pos", "key"])

        for batch in batches:
            out, held = [], 0
            seen: set[int] = set()  # equal sets of this batch are indexed once
            for t in _texts(batch.column(0)):
                s = shingles(t, words)
                n = len(s)
                if not n or (k := _key(s)) in seen:
                    continue
                seen.add(k)
                m = n - -(-percent * n // 100) + 1
                salt = np.full(m, -1)
                if len(places):
                    b = (s >> np.uint64(44)).astype(np.int64)
                    p = np.minimum(np.searchsorted(places, b), len(places) - 1)
                    w = np.where(places[p] == b, weight[p], 0)
                    order = np.argsort(w, kind="stable")
                    s, w = s[order], w[order][:m]
                    salt = np.where(w >= HOT, k % (w * 2 // HOT + 1), -1)
                out.append((s[:m].view(np.int64), salt, np.full(m, n), np.arange(m), np.full(m, k)))
                held += m
                if held >= YIELD:
                    yield made(*zip(*out, strict=True))
                    out, held = [], 0
            if out:
                yield made(*zip(*out, strict=True))

    return run


def _possible(percent: int, na, pa_, nb, pb):
    """Whether the shared element's places leave room for enough overlap; it is the first shared one in the tile that counts."""
    most = np.minimum(na - pa_, nb - pb)
    return 100 * most >= percent * (na + nb - most)


def _shared(percent: int):
    """Postings in (token, salt, n, pos, key) order -> members (token, key, n, pos) of tiles, without rows that no partner can match."""
    names = ["token", "key", "n", "pos"]

    def rows(c, keep):
        return pa.RecordBatch.from_arrays([pa.array(c[x][keep]) for x in (0, 4, 2, 3)], names=names)

    def chosen(c, long):
        """c: whole (token, salt) groups; long: the first group has sent rows before."""
        token, salt, n, pos, key = c
        size = len(token)
        fresh = np.ones(size, bool)
        fresh[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
        c = [x[fresh] for x in c]
        token, salt, n, pos, key = c
        size = len(token)
        keep = salt >= 0
        new = np.ones(size, bool)
        new[1:] = (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])
        start = np.flatnonzero(new)
        length = np.diff(np.append(start, size))
        keep |= np.repeat(length > NEAR, length)
        if long and size:
            keep[: length[0]] = True
        for d in range(1, min(NEAR, size)):
            i = np.flatnonzero((token[d:] == token[:-d]) & ~(keep[d:] & keep[:-d]))
            i = i[_possible(percent, n[i], pos[i], n[i + d], pos[i + d])]
            keep[i] = keep[i + d] = True
        return c, keep

    def run(batches):
        held, long = None, False
        for batch in batches:
            c = [batch.column(x).to_numpy() for x in range(5)]
            if held is not None:
                c = [np.concatenate(x) for x in zip(held, c, strict=True)]
            if not len(c[0]):
                continue
            last = np.flatnonzero((c[0] != c[0][-1]) | (c[1] != c[1][-1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield rows(*chosen([x[:cut] for x in c], long))
                long = False
            held = [x[cut:] for x in c]
            if len(held[0]) > HOT:  # a long tile: its rows go on as they come, but for the last, which the next may repeat
                done, keep = chosen([x[:-1] for x in held], True)
                yield rows(done, keep)
                held, long = [x[-1:] for x in held], True
        if held is not None and len(held[0]):
            yield rows(*chosen(held, long))

    return run


def _matrix(bits: list, rows: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps of ``rows`` as 64-bit words, folded to ``width`` bytes."""
    m = np.frombuffer(b"".join(bits[i] for i in rows), np.uint64).reshape(len(rows), -1)
    while m.shape[1] * 8 > width:
        half = m.shape[1] // 2
        m = m[:, :half] ^ m[:, half:]
    return m


def differing(bits: list, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bits that differ for each pair, the longer bitmap folded to the shorter one's size: at most the sets' symmetric difference."""
    width = np.fromiter(map(len, bits), np.int64, len(bits))
    least, out = np.minimum(width[i], width[j]), np.empty(len(i), np.int64)
    for w in np.unique(least):
        of = np.flatnonzero(least == w)
        used, at = np.unique(np.concatenate([i[of], j[of]]), return_inverse=True)
        m = np.empty((len(used), w // 8), np.uint64)
        for own in np.unique(width[used]):
            m[width[used] == own] = _matrix(bits, used[width[used] == own], w)
        x, y, step = at[: len(of)], at[len(of) :], max(1, (1 << 19) // (w // 8))
        for s in range(0, len(of), step):
            out[of[s : s + step]] = np.bitwise_count(m[x[s : s + step]] ^ m[y[s : s + step]]).sum(1, dtype=np.int64)
    return out


def _cells(percent: int, best: int):
    """Members in (token, cell) order -> pairs (a, b) that pass both bounds, share of differing bits, token; without a and b: the token's tile holds more."""

    def bounded(c, i, j):
        token, cell, side, key, n, pos, root, bits = c
        ok = root[i] != root[j]
        i, j = i[ok], j[ok]
        ok = _possible(percent, n[i], pos[i], n[j], pos[j])
        i, j = i[ok], j[ok]
        d = differing(bits, i, j)
        most = np.minimum(np.minimum(n[i], n[j]), (n[i] + n[j] - d) // 2)
        ok = 100 * most >= percent * (n[i] + n[j] - most)
        return i[ok], j[ok], (d / (n[i] + n[j]))[ok]

    def compared(c):
        """c: whole (token, cell) groups."""
        token, cell, side, key, n, pos, root, bits = c
        size = len(token)
        new = np.ones(size, bool)
        new[1:] = (token[1:] != token[:-1]) | (cell[1:] != cell[:-1])
        start = np.flatnonzero(new)
        length = np.diff(np.append(start, size))
        group = np.repeat(np.arange(len(start)), length)
        small = np.repeat((length <= NEAR), length) & (cell == 0)
        found = []
        for d in range(1, min(NEAR, size)):
            i = np.flatnonzero((group[d:] == group[:-d]) & small[d:])
            found.append(bounded(c, i, i + d))
        for s, m in zip(start, length, strict=True):
            if small[s] or m < 2:
                continue
            own = np.arange(s, s + m)
            left, right = own[side[own] == 0], own[side[own] == 1]
            step = max(1, (1 << 20) // int(m))
            for x in range(0, len(left), step):
                rest = right if len(right) else left[x + 1 :]
                i, j = np.meshgrid(left[x : x + step], rest, indexing="ij")
                i, j = i.ravel(), j.ravel()
                if not len(right):
                    i, j = i[j > i], j[j > i]
                found.append(bounded(c, i, j))
        if not found:
            return None
        i, j, d = (np.concatenate(x) for x in zip(*found, strict=True))
        node, pair = np.concatenate([i, j]), np.tile(np.arange(len(i)), 2)
        order = np.lexsort((d[pair], node))
        node, pair = node[order], pair[order]
        first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else node
        rank = np.arange(len(node)) - np.repeat(first, np.diff(np.append(first, len(node))))
        sent = np.zeros(len(i), bool)
        sent[pair[rank < best]] = True
        more = np.unique(token[i[~sent]])
        x, y = key[i[sent]], key[j[sent]]
        lost, none = pa.nulls(len(more), pa.int64()), pa.nulls(len(more), pa.float64())
        ends = [pa.concat_arrays([pa.array(k, pa.int64()), lost]) for k in (np.minimum(x, y), np.maximum(x, y))]
        return pa.RecordBatch.from_arrays([*ends, pa.concat_arrays([pa.array(d[sent], pa.float64()), none]), pa.array(np.append(token[i[sent]], more))], names=["a", "b", "d", "token"])

    def run(batches):
        held: list | None = None
        for batch in batches:
            c = [batch.column(x).to_numpy() for x in range(7)] + [batch.column(7).to_pylist()]
            if held is not None:
                c = [np.concatenate([x, y]) if isinstance(x, np.ndarray) else x + y for x, y in zip(held, c, strict=True)]
            if not len(c[0]):
                continue
            last = np.flatnonzero((c[0] != c[0][-1]) | (c[1] != c[1][-1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut and (out := compared([x[:cut] for x in c])) is not None:
                yield out
            held = [x[cut:] for x in c]
        if held is not None and len(held[0]) and (out := compared(held)) is not None:
            yield out

    return run


def _verify(words: int, percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                s, r = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(s, r, assume_unique=True))
                keep.append(100 * both >= percent * (len(s) + len(r) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _arrays(words: int):
    def run(batches):
        def made(keys, arrays):
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(arrays, pa.binary())], names=["key", "arr"])

        for batch in batches:
            keys, arrays, held = [], [], 0
            for t in _texts(batch.column(0)):
                s = shingles(t, words)
                keys.append(_key(s))
                arrays.append(s.tobytes())
                held += len(s)
                if held >= YIELD:
                    yield made(keys, arrays)
                    keys, arrays, held = [], [], 0
            if keys:
                yield made(keys, arrays)

    return run


def _stars(batches):
    """Links of a batch -> as few links that join the same keys: each key with the smallest one it reaches here."""
    for batch in batches:
        up: dict[int, int] = {}

        def top(x):
            while (y := up.setdefault(x, x)) != x:
                up[x] = x = up[y]
            return x

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
        keys = np.fromiter(up, np.int64, len(up))
        tops = np.fromiter(map(top, up), np.int64, len(up))
        yield pa.RecordBatch.from_arrays([pa.array(tops[tops != keys]), pa.array(keys[tops != keys])], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """key, root (smallest key reachable) for every key of edges(a, b).

    Links are first replaced, batch by batch, by stars. Then every round each key takes its smallest
    neighbour's smallest neighbour as its new name, links are renamed and those inside one name are
    dropped, so the links shrink from round to round until none is left.
    """
    fewer = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").mapInArrow(_stars, "a long, b long")
    live = common.save(fewer.distinct(), "links")
    labels = common.save(live.select(F.col("a").alias("key")).union(live.select("b")).distinct().select("key", F.col("key").alias("root")), "labels")
    while live.limit(1).count():
        few = common.save(live.mapInArrow(_stars, "a long, b long").distinct(), "stars")
        ends = few.select(F.col("a").alias("key"), F.col("b").alias("other")).union(few.select("b", "a"))
        up = common.save(ends.groupBy("key").agg(F.least(F.min("other"), F.col("key")).alias("up")), "parents")
        top = up.select(F.col("key").alias("up"), F.col("up").alias("new"))
        name = common.save(up.join(top, "up").select("key", "new"), "names")
        new = labels.join(name.withColumnRenamed("key", "root"), "root", "left").select("key", F.coalesce("new", "root").alias("root"))
        new = common.save(new, "labels")
        left, right = name.select(F.col("key").alias("a"), F.col("new").alias("na")), name.select(F.col("key").alias("b"), F.col("new").alias("nb"))
        rest = few.join(left, "a").join(right, "b").where("na <> nb").select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct()
        rest = common.save(rest, "links")
        common.forget(live, few, labels, up, name)
        live, labels = rest, new
    common.forget(live)
    return labels


def _dealt(members: DataFrame, percent: int, block: int, width: int) -> DataFrame:
    """members with token, cell, side: the block pairs of its tile that each row takes part in.

    Cell 0 is a whole tile. Of tiles of over ``block`` rows or ``width`` bytes of bitmaps, band b is cut into
    blocks by key, and cells are the pairs of blocks of one band or of b and b + 1.
    """
    # the small addend keeps partners at exactly the factor t in neighbouring bands
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("long")
    m = members.withColumn("band", band)
    parts = m.groupBy("token", "band").agg(F.count("*").alias("rows"), F.sum(F.greatest(F.lit(64), F.col("n") / 4)).alias("bytes"))
    parts = parts.withColumn("blocks", F.ceil(F.greatest(F.col("rows") / block, F.col("bytes") / width)).cast("long"))
    large = parts.groupBy("token").agg(F.map_from_entries(F.collect_list(F.struct("band", "blocks"))).alias("blocks"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).where((F.col("rows") > block) | (F.col("bytes") > width)).select("token", "blocks")
    count = lambda b: F.coalesce(F.try_element_at("blocks", b), F.lit(0).cast("long"))
    number = lambda b, kind, i, j: F.shiftleft(b * 2 + kind + 1, 52) + F.shiftleft(i, 26) + j
    each = lambda n, f: F.transform(F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<long>")), f)
    one = F.lit(1).cast("long")
    b, i = F.col("band"), F.pmod(F.xxhash64("key"), count(F.col("band")))
    cell = lambda number, side: F.struct(number.alias("cell"), side.cast("int").alias("side"))
    same = each(count(b), lambda j: cell(number(b, 0, F.least(i, j), F.greatest(i, j)), j < i))
    above = each(count(b + one), lambda j: cell(number(b, 1, i, j), F.lit(0)))
    below = each(count(b - one), lambda j: cell(number(b - one, 1, j, i), F.lit(1)))
    whole = F.array(cell(F.lit(0).cast("long"), F.lit(0)))
    cells = F.when(F.col("blocks").isNull(), whole).otherwise(F.concat(same, above, below))
    return m.join(large, "token", "left").withColumn("at", F.explode(cells)).select("*", "at.cell", "at.side").drop("at", "blocks", "band")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, block: int = 1024, width: int = 1 << 23, best: int = 2) -> DataFrame:
    """One row per input row: id_col, n_shingles, component_id.

    A null, empty or blank text has no shingles and is its own component. Rows with repeated ids are
    linked by their own texts; component_id is the smallest id of the component that is not null,
    null if it has none. An empty table gives an empty result; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    read = common.save(base.mapInArrow(_sets(words), f"id {kind}, n long, key long, bits binary, counts binary"), "sets")
    nodes = read.where("key IS NOT NULL").drop("counts")
    found = read.where("counts IS NOT NULL").select("counts").mapInArrow(_buckets, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "bucket").limit(HEAVY).collect()
    postings = base.select("t").mapInArrow(_prefixes(words, percent, {r["bucket"]: r["n"] for r in found}), "token long, salt long, n long, pos long, key long")
    tiles = postings.repartition("token", "salt").sortWithinPartitions("token", "salt", "n", "pos", "key")
    members = common.save(tiles.mapInArrow(_shared(percent), "token long, key long, n long, pos long"), "members")
    common.release(docs.sparkSession)
    unique = nodes.where("n > 0").join(members.select("key").distinct(), "key", "left_semi")
    unique = common.save(unique.groupBy("key").agg(F.first("bits").alias("bits"), F.min("id").alias("rep")), "unique-sets")

    def read_arrays(pairs: DataFrame) -> DataFrame:
        """Sorted arrays of all nodes in pairs. Every node with a pair sends its best one in the first round, so these serve all rounds."""
        wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
        ids = unique.join(wanted, "key", "left_semi").select("rep").distinct()
        texts = base.join(ids, base["id"].eqNullSafe(ids["rep"]), "left_semi").select("t")
        found = texts.mapInArrow(_arrays(words), "key long, arr binary").join(wanted, "key", "left_semi")
        return common.save(found.groupBy("key").agg(F.first("arr").alias("arr")), "arrays")

    def verified(pairs: DataFrame) -> DataFrame:
        left, right = arrays.select(F.col("key").alias("a"), F.col("arr").alias("x")), arrays.select(F.col("key").alias("b"), F.col("arr").alias("y"))
        return common.save(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_verify(words, percent), "a long, b long"), "links")

    arrays = None
    left, roots = members, None
    while left is not None:
        nodes_of = unique.select("key", "bits", F.col("key").alias("root")) if roots is None else unique.select("key", "bits").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
        dealt = _dealt(left, percent, block, width).join(nodes_of, "key").select("token", "cell", "side", "key", "n", "pos", "root", "bits")
        dealt = dealt.repartition("token", "cell").sortWithinPartitions("token", "cell", "n", "key")
        near = common.save(dealt.mapInArrow(_cells(percent, best), "a long, b long, d double, token long"), "bounded-pairs")
        common.release(docs.sparkSession)
        pairs = near.where("a IS NOT NULL").groupBy("a", "b").agg(F.min("d").alias("d"), F.min("token").alias("token"))
        ends = pairs.select("*", F.explode(F.array("a", "b")).alias("node"))
        first = F.row_number().over(Window.partitionBy("node").orderBy("d", "a", "b")) <= best
        sent = common.save(ends.withColumn("sent", first).groupBy("a", "b", "token").agg(F.max("sent").alias("sent")), "ranked-pairs")
        picked = sent.where("sent").select("a", "b")
        if arrays is None:
            arrays = read_arrays(picked)
        links = verified(picked)
        new = components(links if roots is None else links.union(roots.select("root", "key"))) if roots is None or links.limit(1).count() else roots
        common.forget(links, *([left] if left is not members else []), *([roots] if roots is not None and roots is not new else []))
        left, roots, best = None, new, best * 4
        held = sent.where("NOT sent").select("token").union(near.where("a IS NULL").select("token")).distinct()
        if held.limit(1).count():  # of the tiles with pairs held back, those that are not yet in one component
            again = members.join(held, "token", "left_semi")
            root = F.coalesce("root", "key")
            apart = again.join(roots, "key", "left").groupBy("token").agg(F.min(root).alias("lo"), F.max(root).alias("hi")).where("lo < hi").select("token")
            left = common.save(again.join(apart, "token", "left_semi"), "open-members")
        common.forget(near, sent)
    common.forget(members, unique, arrays)
    labelled = nodes.join(roots, "key", "left").select("id", "n", F.when(F.col("n") > 0, F.coalesce("root", "key")).alias("root"))
    smallest = labelled.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("component_id"))
    return labelled.join(smallest, "root", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row of each component, that with the smallest id, with all columns; rows that repeat that id stay with it."""
    stay = jaccard_components(docs, id_col, text_col, **how).where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("stay")).distinct()
    return docs.join(stay, docs[id_col].eqNullSafe(stay["stay"]), "left_semi")
