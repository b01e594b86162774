"""URL filter by path-template trees, with DataFrame functions only.

A url is cut into host and path. Within a host the path's segments become a template, level by level: a
segment of digits or hexadecimal digits is a wildcard at once, and all segments below a node become
one when the node has many distinct children with one or two distinct paths each, however often these are seen; the shares are counted
again on the new templates until no node changes.

Every template lies in three trees, that of all hosts, of its domain and of its host, and has one node for
each depth in each of them, the root included. A node's purity is the share of blocked ones among its labelled urls (in
its host's tree) or the mean of its hosts' shares (in the wider trees, so that no large host speaks for all).
Read from the widest root to the host's own leaf, a node whose share lies within ``merge_z`` standard
errors of what was known before, or that has no labels, is merged into that; otherwise its share,
smoothed by what was known before with weight ``alpha``, takes over. A template is rejected when the last purity exceeds ``block_at``.

The labels are the rules' own verdicts. Counts are combined on the map side and per template, so a host
that a third of all rows share costs one row per task and template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: rule name -> (host suffix, path prefix, verdict); the longest name that fits wins
RULES = {"net/": ("net", "/", "block"), "example.net/en/": ("example.net", "/en/", "allow"), "example.com/de/": ("example.com", "/de/", "block"), "org/fr/": ("org", "/fr/", "allow")}


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(name: str) -> Column:
    suffix, prefix, _ = RULES[name]
    return ((F.col("host") == suffix) | F.col("host").endswith("." + suffix)) & F.col("path").startswith(prefix)


def _shape(path: Column) -> Column:
    """Segments of a path with wildcards for digits and long hexadecimal runs."""
    plain = F.regexp_replace(F.regexp_replace(path, r"(?<![0-9a-zA-Z])[0-9a-f-]{16,}(?![0-9a-zA-Z])", "*"), r"[0-9]+", "*")
    return F.filter(F.split(plain, "/"), lambda s: s != "")


def _nodes(root: Column, shape: Column) -> Column:
    """Hashes of the node of every depth, the root first."""
    seed = F.xxhash64(root)
    return F.aggregate(shape, F.array(seed), lambda a, s: F.concat(a, F.array(F.xxhash64(F.element_at(a, -1), s))))


def _generalised(paths: DataFrame, min_children: int, variable_share: float) -> DataFrame:
    """paths (host, path, shape, n, ..) with the segments below nodes of many thin children turned into wildcards."""
    while True:
        each = paths.select("host", "path", "n", F.posexplode(F.arrays_zip(_nodes(F.col("host"), F.col("shape")), F.col("shape"))).alias("level", "s"))
        each = each.select("host", "path", "n", "level", F.col("s")["0"].alias("parent"), F.col("s")["shape"].alias("seg")).where("seg IS NOT NULL AND seg <> '*'")
        kids = each.groupBy("parent", "seg").agg(F.count(F.lit(1)).alias("below"))
        wide = kids.groupBy("parent").agg(F.count(F.lit(1)).alias("kids"), F.sum("below").alias("below")).where((F.col("kids") >= min_children) & (F.col("kids") >= variable_share * F.col("below")))
        wide = common.save(wide.select("parent"), "url-variable")
        if not wide.limit(1).count():
            common.forget(wide)
            return paths
        levels = each.join(wide, "parent", "left_semi").groupBy("host", "path").agg(F.collect_set("level").alias("levels"))
        shape = F.when(F.col("levels").isNull(), F.col("shape")).otherwise(F.transform("shape", lambda s, i: F.when(F.array_contains("levels", i), "*").otherwise(s)))
        old, paths = paths, common.save(paths.join(levels, ["host", "path"], "left").withColumn("shape", shape).drop("levels"), "url-paths")
        common.forget(old, wide)


def judged_templates(paths: DataFrame, merge_z: float, alpha: float, block_at: float) -> DataFrame:
    """host, shape, purity, verdict of every template; paths: host, shape, bad, labelled (counts of urls)."""
    templates = paths.groupBy("host", "shape").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled"))
    domain = F.regexp_extract("host", r"([^.]*\.?[^.]*)$", 1)
    trees = [(F.lit("all hosts"), 0), (F.concat(F.lit("domain "), domain), 0), (F.concat(F.lit("host "), F.col("host")), 1)]
    marked = lambda own: lambda h: F.struct(h.alias("node"), F.lit(own).alias("own"))
    chain = F.concat(*[F.transform(_nodes(root, F.col("shape")), marked(own)) for root, own in trees])
    placed = templates.select("host", "shape", "bad", "labelled", F.posexplode(chain).alias("place", "c")).select("host", "shape", "bad", "labelled", "place", "c.node", "c.own")
    per_host = placed.where("labelled > 0").groupBy("node", "own", "host").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled"))
    share = F.col("bad") / F.col("labelled")
    known = per_host.groupBy("node").agg(F.sum(F.when(F.col("own") == 1, F.col("bad")).otherwise(share)).alias("b"), F.sum(F.when(F.col("own") == 1, F.col("labelled")).otherwise(1)).alias("m"))
    marks = placed.select("host", "shape", "place", "node").join(known, "node").groupBy("host", "shape").agg(F.array_sort(F.collect_list(F.struct("place", "b", "m"))).alias("marks"))

    def takes(p: Column, x: Column) -> Column:
        q, m = x["b"] / x["m"], x["m"].cast("double")
        spread = F.sqrt(F.greatest(p * (1 - p), F.lit(0.0)) / m)
        return F.when(F.abs(q - p) <= merge_z * spread, p).otherwise((x["b"] + alpha * p) / (m + alpha))

    purity = F.round(F.when(F.col("marks").isNull(), F.lit(0.5)).otherwise(F.aggregate("marks", F.lit(0.5), takes)), 9)
    return templates.join(marks, ["host", "shape"], "left").select("host", "shape", purity.alias("purity"), F.when(purity > block_at, "block").otherwise("allow").alias("verdict"))


def url_filter(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", min_children: int = 16, variable_share: float = 0.5, merge_z: float = 2.0, alpha: float = 2.0, block_at: float = 0.75, hide: Column | None = None) -> DataFrame:
    """One row per input row: id_col, host, path, rule, verdict, template, purity.

    Purity starts at 0.5, so a template that nothing is known of is allowed, as is a tie at ``block_at``. ``hide``
    (over id, host, path) marks ruled rows that teach nothing; their purity tells how well the trees foresee the rules.
    Repeated rows are judged alike and count as often as they occur, an empty table gives an empty result, other columns are ignored.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("u"))
    host, path = host_and_path(F.col("u"))
    rows = rows.select("id", host.alias("host"), path.alias("path"))
    rule = F.lit(None).cast("string")
    for name in sorted(RULES, key=len):
        rule = F.when(_fits(name), F.lit(name)).otherwise(rule)
    ruled = F.coalesce(*[F.when(F.col("rule") == name, F.lit(v)) for name, (_, _, v) in RULES.items()])
    rows = rows.withColumn("rule", rule).withColumn("ruled", ruled)
    teaches = F.col("ruled").isNotNull() & (~F.coalesce(hide, F.lit(False)) if hide is not None else F.lit(True))
    seen = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.count_if(teaches & (F.col("ruled") == "block")).alias("bad"), F.count_if(teaches).alias("labelled"))
    paths = _generalised(common.save(seen.withColumn("shape", _shape(F.col("path"))), "url-paths"), min_children, variable_share)
    verdicts = judged_templates(paths, merge_z, alpha, block_at)
    known = paths.select("host", "path", "shape").join(verdicts, ["host", "shape"])
    template = F.concat(F.lit("/"), F.array_join("shape", "/"))
    return rows.join(known, ["host", "path"], "left").select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", "verdict").alias("verdict"), template.alias("template"), "purity")
