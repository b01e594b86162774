"""Benchmark decontamination by template windows, with DataFrame functions only.

Words are stripped of outer punctuation and lower-cased; in the template, numbers, names (capitalised
words inside a sentence) and units become typed placeholders. Every window of ``seed`` template
words of the benchmark is hashed and joined with the documents' windows; a window with slots is also
looked up by its plain words, as a change of case hides names. An inserted or deleted word moves all
that follows, so hits of one (document, item) whose shifts differ by less than half the item are
joined before coverage is tested: candidates have ``least`` of the item's words covered and
``anchor`` of them in one run, or a run of ``run`` words, which tells a passage of a long item. The
words of candidates are then laid side by side: one counts when equal plain runs of ``window`` words
cover as much, or a plain run of ``run`` words is equal, or when every slot value of the item stands
for one value of the document throughout, so that a re-parameterised question counts as well as a copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: fixed word list of measurement units
UNITS = "km cm mm kg mg lb oz mph kph km/h m/s ms min hr hrs hours hour minutes minute seconds second days day weeks week months month years year meters meter metres metre miles mile feet foot inches inch grams gram litres liters dollars euros percent"
MAX_BROADCAST_BYTES = 16 << 20  # of the written table of the benchmark's windows
NAME, NUMBER, UNIT = "\ue000", "\ue001", "\ue002"
_OUTER = r"[^\p{L}\p{N}%\x20]*+\x20[^\p{L}\p{N}\x20\ue000]*+"  # one blank; runs of them are joined afterwards, as a repeated group would recurse


def _words(df: DataFrame) -> DataFrame:
    """Adds pw (plain words) and ks (template words), arrays of one length.

    The text gets a space at each end, so patterns begin at a space instead of looking behind every
    character. A word counts as a unit only after a number.
    """
    tidy = F.concat(F.lit(" "), F.regexp_replace(F.translate("t", NAME + NUMBER + UNIT, ""), r"[\x09-\x0D]", " "), F.lit(" "))
    named = F.regexp_replace(tidy, r"([^.!?:|\x20]\x20+)(?=\p{Lu}\p{Ll})", "$1" + NAME)
    out = df.withColumn("marked", F.lower(F.regexp_replace(F.regexp_replace(named, _OUTER, " "), r"\x20{2,}", " ")))
    number = F.regexp_replace("marked", r"\x20\p{N}[\p{N}.,:/-]*+%?(?=\x20)", " " + NUMBER)
    slots = F.regexp_replace(F.regexp_replace(number, rf"{NUMBER} (?:{'|'.join(UNITS.split())})(?=\x20)", f"{NUMBER} {UNIT}"), rf"{NAME}[^\x20]+", NAME)
    return out.select(*[c for c in df.columns if c != "t"], F.split(F.trim(F.replace("marked", F.lit(NAME), F.lit(""))), " ").alias("pw"), F.split(F.trim(slots), " ").alias("ks"))


def _windows(df: DataFrame, n: int, shorter: list[int]) -> DataFrame:
    """id, pos (from 1), key: a row per window of n words, or of one of the ``shorter`` sizes, and one more where plain words differ; a text of less than n words is one window too."""
    size = F.size("ks")
    starts = lambda m: F.sequence(F.lit(1), F.greatest(size - (m - 1), F.lit(1)))
    at = F.transform(starts(n), lambda p: F.struct(p.alias("pos"), F.lit(n).alias("long"))) if shorter else starts(n)
    for m in shorter:
        at = F.concat(at, F.when(size >= m, F.transform(starts(m), lambda p: F.struct(p.alias("pos"), F.lit(m).alias("long")))).otherwise(F.array().cast("array<struct<pos:int,long:int>>")))
    words = _words(df).where(F.get("pw", 0) != "").select("id", "ks", "pw", F.explode(at).alias("at"))
    pos, long = ("at.pos", F.col("at.long")) if shorter else ("at", n)
    part = lambda c: F.xxhash64(F.slice(c, F.col(pos), long))
    keys = words.select("id", F.col(pos).alias("pos"), part("ks").alias("k"), part("pw").alias("p"))
    return keys.select("id", "pos", F.explode(F.when(F.col("k") == F.col("p"), F.array("k")).otherwise(F.array("k", "p"))).alias("key"))


def _chain(a: Column, h: Column) -> Column:
    goes_on = (h["shift"] == a["shift"]) & (h["item_pos"] == a["p"] + 1)
    now = F.when(goes_on, a["now"] + 1).otherwise(F.lit(1))
    return F.struct(h["shift"].alias("shift"), h["item_pos"].alias("p"), now.alias("now"), F.greatest(a["top"], now).alias("top"))


def _lane(shift: Column, at: Column) -> Column:
    return F.struct((-F.size(at)).alias("few"), shift.alias("shift"), at.alias("at"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = 8, least: float = 0.4, seed: int = 4, anchor: int = 5, run: int = 13) -> DataFrame:
    """One row per contaminated (document, item): id_col, item_id, n_windows, item_windows, share, exact, first_word.

    n_windows and item_windows count windows of ``seed`` words, share is that of the item's words
    covered, exact says that none of these differs. Of several places in a document the one with
    most words covered is reported, of equals the exact one, then the first. Null and empty texts match nothing, repeated rows give one
    row a pair, an empty table on either side gives an empty result; other columns are ignored. Rows
    with a null id are not looked at. An item of two words up to ``seed`` - 1 is looked up at its own
    length and must stand there as it is; one of a single word only matches a text of that word. The
    item side is broadcast only while its written table has at most MAX_BROADCAST_BYTES; beyond that
    the windows are joined by shuffle. An item's repeated window counts once, at its first place.
    """
    bench = benchmark.select(F.col(item_col).alias("id"), common.text_of(item_text).alias("t")).where(F.col("id").isNotNull()).dropDuplicates(["id", "t"])
    items = _windows(bench, seed, []).groupBy(F.col("id").alias("item_id"), "key").agg(F.min("pos").alias("item_pos"))
    beside = _words(bench).where(F.get("pw", 0) != "").select(F.col("id").alias("item_id"), F.col("pw").alias("item_words"), F.col("ks").alias("item_slots"))
    sizes = items.groupBy("item_id").agg(F.countDistinct("item_pos").cast("int").alias("item_windows"))
    lengths = beside.groupBy("item_id").agg(F.max(F.size("item_words")).alias("n"))
    items = common.save(items.join(sizes, "item_id").join(lengths, "item_id"), "bench-windows")
    small = common.written_bytes(items) <= MAX_BROADCAST_BYTES
    shorter = sorted(r["n"] for r in items.where(F.col("n").between(2, seed - 1)).select("n").distinct().collect())  # at most seed - 2 sizes
    rows = docs.select(F.col(id_col).alias("id"), common.text_of(text_col).alias("t")).where(F.col("id").isNotNull())
    found = _windows(rows, seed, shorter).join(F.broadcast(items) if small else items, "key").withColumn("shift", F.col("pos") - F.col("item_pos"))
    # shifts less than half an item apart share a band: band b holds those from b to b + 2 such steps
    band = F.floor(F.col("shift") / F.greatest(F.lit(seed), F.ceil(F.col("n") / 2))).cast("int")
    hit = F.struct("shift", "item_pos")
    near = found.withColumn("band", F.explode(F.array(band - 1, band))).groupBy("id", "item_id", "band").agg(F.sort_array(F.collect_set(hit)).alias("hits"), F.max("item_windows").alias("item_windows"), F.max("n").alias("n"))
    spread = lambda starts, long: F.array_distinct(F.flatten(F.transform(starts, lambda p: F.sequence(p - 1, F.least(p - 1 + long, F.col("n")) - 1))))
    # a run is a chain of hits of one shift at neighbouring places
    chained = F.aggregate("hits", F.struct(F.lit(None).cast("int").alias("shift"), F.lit(0).alias("p"), F.lit(0).alias("now"), F.lit(0).alias("top")), _chain)["top"]
    near = near.withColumn("covered", spread(F.array_distinct(F.transform("hits", lambda h: h["item_pos"])), seed)).withColumn("chained", chained)
    longest = F.col("chained") + (seed - 1)
    enough = (F.size("covered") >= least * F.col("n")) & (longest >= F.least(F.lit(anchor), F.col("n")))
    near = common.save(near.where(enough | (longest >= run)), "alignments")
    # candidates only: their words side by side
    texts = rows.join(near.select("id").distinct(), "id", "left_semi")
    both = _words(texts).select("id", "pw").join(near, "id").join(beside, "item_id").where(F.size("item_words") == F.col("n"))
    # an item word is read at the shift with most hits that covers it
    shifts = F.array_distinct(F.transform("hits", lambda h: h["shift"]))
    lanes = F.sort_array(F.transform(shifts, lambda s: _lane(s, F.transform(F.filter("hits", lambda h: h["shift"] == s), lambda h: h["item_pos"]))))
    both = both.withColumn("lanes", lanes)
    pick = lambda q: F.get(F.filter("lanes", lambda x: F.exists(x["at"], lambda p: (p - 1 <= q) & (q < p - 1 + seed))), 0)["shift"]
    both = both.withColumn("beside", F.transform("covered", lambda q: F.struct(F.get("item_words", q).alias("ours"), F.coalesce(F.get("pw", q + pick(q)), F.lit("")).alias("theirs"), F.get("item_slots", q).isin(NAME, NUMBER, UNIT).alias("slot"))))
    pairs = F.array_distinct(F.transform(F.filter("beside", lambda x: x["slot"]), lambda x: F.struct(x["ours"], x["theirs"])))
    both = both.withColumn("pairs", pairs).withColumn("exact", F.forall("beside", lambda x: x["ours"] == x["theirs"]))
    equal = lambda h, long: (h["item_pos"] + (long - 1) <= F.col("n")) & (F.slice("item_words", h["item_pos"], long) == F.slice("pw", h["item_pos"] + h["shift"], long))
    plain = F.transform(F.filter("hits", lambda h: equal(h, F.least(F.lit(window), F.col("n")))), lambda h: h["item_pos"])
    copied = (F.size(spread(plain, window)) >= least * F.col("n")) | F.exists("hits", lambda h: equal(h, F.lit(run)))
    refilled = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda x: x["ours"])))
    first = F.array_min(F.transform("hits", lambda h: h["item_pos"] + h["shift"])).cast("long")
    one = both.where(copied | (refilled & (F.col("n") >= seed)))
    best = F.struct(F.size("covered").alias("n_covered"), "exact", (-first).alias("back"), F.size(F.array_distinct(F.transform("hits", lambda h: h["item_pos"]))).cast("long").alias("n_windows"), F.col("item_windows").cast("long").alias("item_windows"), (F.size("covered") / F.col("n")).alias("share"))
    out = one.groupBy("id", "item_id").agg(F.max(best).alias("f"))
    return out.select(F.col("id").alias(id_col), "item_id", "f.n_windows", "f.item_windows", "f.share", "f.exact", (-F.col("f.back")).alias("first_word"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The rows of docs without a contaminated pair, all columns; rows with a null id stay."""
    bad = contamination(docs, benchmark, id_col, **how).select(F.col(id_col).alias("bad")).distinct()
    return docs.join(bad, docs[id_col] == bad["bad"], "left_anti")
