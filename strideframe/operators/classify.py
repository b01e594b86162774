"""Ordered rules: classes, refusals and keep filters as Columns over named inputs. The first rule that holds decides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_rule(rules: list[tuple[Column, str]], otherwise: str | None = None) -> Column:
    out = F.lit(otherwise).cast("string")
    for holds, label in reversed(rules):
        out = F.when(F.coalesce(holds, F.lit(False)), F.lit(label)).otherwise(out)
    return out


def rerun_category() -> Column:
    """What to do with an unfinished map: drop, retry, clearance45, lookup10, indoor_sky or review; null once it passed.

    Inputs: state, slug, gates, kept, error, attempt, note, clamped, sky, sky_phases.
    """
    c = F.col
    only_probe = F.coalesce(c("gates") == F.array(F.lit("depth_probe_clear")), F.lit(False))
    phases = c("sky_phases")
    listed = lambda g: F.array_contains("gates", g)
    timed_out = c("state") == "timeout"
    return first_rule([
        (c("state") == "geometry_pass", "passed"),
        (c("state") == "blocked_asset", "drop"),
        (c("slug").endswith("Traditional_Map"), "drop"),
        (listed("action_mix_in_band"), "drop"),
        (c("kept") < 0.10, "drop"),
        (timed_out & c("error").contains("RpcTimeout"), "retry"),
        ((c("state") == "route_failed") & (F.coalesce("attempt", F.lit(0)) == 0) & c("note").contains("start point"), "retry"),
        ((c("state") == "coverage_review") | F.coalesce(listed("collision_free"), F.lit(False)) | (F.coalesce("clamped", F.lit(0)) > 0), "clearance45"),
        (only_probe & (F.size(phases) > 0) & F.forall(phases, lambda p: p == "look_up"), "lookup10"),
        (only_probe & (c("sky") > 0) & F.exists(phases, lambda p: ~p.eqNullSafe(F.lit("look_up"))), "indoor_sky"),
        (only_probe, "lookup10"),
        (timed_out, "clearance45"),
    ], "review")


def level_class() -> Column:
    """A record now, B look at it, C run again, D mend the route, E not verified, F left out, G given up, H never chosen.

    Inputs: excluded, dropped, state, recorded, tried, failed, centreline_m, error.
    """
    c = F.col
    failed_route = c("state").isin("route_failed", "blocked_asset")
    says = lambda *words: F.coalesce(c("error").rlike("|".join(words)), F.lit(False))
    short = F.coalesce(c("dropped"), F.lit(False)) | F.coalesce(F.array_contains("failed", "network_too_short"), F.lit(False)) | F.coalesce(c("centreline_m") < 50, F.lit(False))
    return first_rule([
        (c("excluded"), "F"),
        ((c("state") == "geometry_pass") | F.coalesce(c("recorded"), F.lit(False)), "A"),
        (c("state") == "coverage_review", "B"),
        (c("state").isin("failed", "timeout", "running", "interrupted", "starting", "connecting"), "C"),
        (failed_route & short, "G"),
        (failed_route & says("no usable road network", "area floor"), "G"),
        (failed_route & says("blocked at the agent"), "G"),
        (failed_route, "D"),
        (c("tried"), "E"),
    ], "H")


def route_status() -> Column:
    """Status of a route before a review overrides it. Inputs: route_kind, unmeasured, kept, failed_prechecks."""
    c = F.col
    return first_rule([
        ((c("route_kind") == "none") & c("unmeasured"), "mend_start"),
        (c("route_kind").isin("none", "short_route"), "needs_full_route"),
        (c("kept") < 0.75, "check_missing_roads"),
        (F.size("failed_prechecks") > 0, "prechecks_failed"),
    ], "candidate")


def requeue_class() -> Column:
    """keep, lighting, reseed or retry of an ended shard. Inputs: state, error, frames (of any attempt)."""
    c = F.col
    text = F.coalesce("error", F.lit(""))
    has = lambda x, *words: x.rlike("|".join(words))
    return first_rule([
        (c("state").isin("accepted", "rejected") | F.coalesce(c("frames") > 0, F.lit(False)), "keep"),
        (has(text, "sky-light", "apply_fill"), "lighting"),
        (has(F.coalesce("state", F.lit("")), "depth_probe", "collision") | has(text, "depth", "collision"), "reseed"),
    ], "retry")


def refusal(kept_least: float = 0.75) -> Column:
    """Why a plan must not be recorded, null if it may. Inputs: collision_free, probe_clear, kept_fraction, coverage_fraction."""
    c = F.col
    return first_rule([
        (~F.coalesce(c("collision_free"), F.lit(False)), "refused_collision"),
        (~F.coalesce(c("probe_clear"), F.lit(False)), "refused_depth_probe"),
        (F.coalesce("kept_fraction", F.lit(1.0)) < kept_least, "refused_disconnected_network"),
        (c("coverage_fraction") < 1, "refused_partial_cover"),
    ])


def refusal_reason() -> Column:
    """Every veto that fired, joined, for a refused plan. Further inputs: collision_count, clamped, sky, thin."""
    c = F.col
    part = lambda n, words: F.when(F.coalesce(c(n) > 0, F.lit(False)), F.concat(c(n).cast("string"), F.lit(" " + words)))
    probe = F.concat_ws("; ", part("clamped", "clamped at the near plane"), part("sky", "without valid depth"), part("thin", "with thin depth"))
    return F.when(~F.coalesce(c("collision_free"), F.lit(False)), part("collision_count", "sweeps hit")).when(~F.coalesce(c("probe_clear"), F.lit(False)), F.coalesce(F.nullif(probe, F.lit("")), F.lit("no named reason")))


#: fixed values: actor classes that stand for no obstacle
NOT_SOLID = "Landscape|InstancedFoliage|Sky|Atmosphere|Fog|Volume|Brush|Light|Camera|PlayerStart|NavMesh|RecastNavMesh|WorldSettings|Cloud|Water|PostProcess|ReflectionCapture|Decal|Note|TextRender|Spline|Trigger"


def solid_footprint(z_lo: float, z_hi: float, widest_cm: float = 20000.0, least_m2: float = 2.0) -> Column:
    """Keeps actors whose bounds (x, y, z, ext_x, ext_y, ext_z) overlap the height band, of a sane size and a solid class."""
    c = F.col
    sized = (c("ext_x") > 0) & (c("ext_y") > 0) & (c("ext_x") <= widest_cm) & (c("ext_y") <= widest_cm)
    return sized & overlaps(c("z") - c("ext_z"), c("z") + c("ext_z"), F.lit(z_lo), F.lit(z_hi)) & (4 * c("ext_x") * c("ext_y") / 1e4 >= least_m2) & ~c("class").rlike(NOT_SOLID)


def overlaps(lo: Column, hi: Column, from_: Column, to: Column) -> Column:
    """Closed intervals share a point."""
    return (lo <= to) & (hi >= from_)


def keep_clip(edge_least: float, motion_least: float) -> Column:
    return (F.col("edge") >= edge_least) & (F.coalesce("motion", F.lit(0.0)) >= motion_least)


def tagged(tag: str) -> Column:
    """A clip carries a tag as a move or a speed; null and '*' keep everything."""
    if not tag or tag == "*":
        return F.lit(True)
    has = lambda m: F.coalesce(F.map_contains_key(m, tag), F.lit(False))
    return has("move") | has("speeds")


def numeric(*names: str) -> Column:
    """All named text values are numbers."""
    out = F.lit(True)
    for n in names:
        out = out & F.expr(f"try_cast({n} AS double)").isNotNull()
    return out
