"""Geometry and angle scalars as Column expressions (centimetres, degrees, Z up)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wrapped_diff(a: Column, b: Column) -> Column:
    """Absolute angle between two headings, in [0, 180]; pmod keeps it right for negative differences."""
    return F.abs(F.pmod(a - b + 540, F.lit(360.0)) - 180)


def focal_px(width: Column, fov_deg: Column) -> Column:
    return width / (2 * F.tan(F.radians(fov_deg) / 2))


def scale_intrinsics(fx: Column, old_width: Column, new_width: Column) -> Column:
    return fx * new_width / old_width


def basis(pitch: Column, yaw: Column, roll: Column) -> dict[str, tuple[Column, Column, Column]]:
    """Forward, right and up vectors of a pitch-yaw-roll rotation."""
    sp, cp = F.sin(F.radians(pitch)), F.cos(F.radians(pitch))
    sy, cy = F.sin(F.radians(yaw)), F.cos(F.radians(yaw))
    sr, cr = F.sin(F.radians(roll)), F.cos(F.radians(roll))
    return {
        "forward": (cp * cy, cp * sy, sp),
        "right": (sr * sp * cy - cr * sy, sr * sp * sy + cr * cy, -sr * cp),
        "up": (-(cr * sp * cy + sr * sy), cy * sr - cr * sp * sy, cr * cp),
    }


def camera_to_world(x: Column, y: Column, z: Column, pitch: Column, yaw: Column, roll: Column) -> Column:
    """Row-major 4x4 in metres; the columns are right, down and forward."""
    b = basis(pitch, yaw, roll)
    place = (x / 100, y / 100, z / 100)
    rows = [v for i in range(3) for v in (b["right"][i], -b["up"][i], b["forward"][i], place[i])]
    return F.array(*rows, F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))


def quaternion_from_matrix(m: list[list[Column]]) -> Column:
    """Unit quaternion (x, y, z, w) of a rotation matrix; the largest diagonal term picks the branch."""
    trace = m[0][0] + m[1][1] + m[2][2]
    s0 = 2 * F.sqrt(F.greatest(trace + 1, F.lit(0.0)))
    branches = [F.array((m[2][1] - m[1][2]) / s0, (m[0][2] - m[2][0]) / s0, (m[1][0] - m[0][1]) / s0, s0 / 4)]
    for i in range(3):
        j, k = (i + 1) % 3, (i + 2) % 3
        s = 2 * F.sqrt(F.greatest(1 + m[i][i] - m[j][j] - m[k][k], F.lit(0.0)))
        q: list[Column] = [F.lit(0.0)] * 4
        q[i], q[j], q[k], q[3] = s / 4, (m[j][i] + m[i][j]) / s, (m[k][i] + m[i][k]) / s, (m[k][j] - m[j][k]) / s
        branches.append(F.array(*q))
    big = F.greatest(m[0][0], m[1][1], m[2][2])
    return F.when(trace > 0, branches[0]).when(m[0][0] == big, branches[1]).when(m[1][1] == big, branches[2]).otherwise(branches[3])


def project(c2w: Column, px: Column, py: Column, pz: Column, f: Column, cx: Column, cy: Column) -> Column:
    """Pixel (u, v) of a point in metres, null behind the camera; the inverse of a rigid motion is its transpose."""
    d = [p - F.get(c2w, 4 * i + 3) for i, p in enumerate((px, py, pz))]
    cam = [sum((F.get(c2w, 4 * i + c) * d[i] for i in range(3)), F.lit(0.0)) for c in range(3)]
    return F.when(cam[2] > 1e-9, F.array(f * cam[0] / cam[2] + cx, f * cam[1] / cam[2] + cy))


def triangle_area(ax, ay, az, bx, by, bz, cx, cy, cz) -> Column:
    u, v = (bx - ax, by - ay, bz - az), (cx - ax, cy - ay, cz - az)
    x = (u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0])
    return F.sqrt(x[0] * x[0] + x[1] * x[1] + x[2] * x[2]) / 2


def inside_triangle(px, py, ax, ay, bx, by, cx, cy) -> Column:
    """Barycentric point-in-triangle test, edges included; false for a degenerate triangle."""
    det = (by - cy) * (ax - cx) + (cx - bx) * (ay - cy)
    u = ((by - cy) * (px - cx) + (cx - bx) * (py - cy)) / F.nullif(det, F.lit(0.0))
    v = ((cy - ay) * (px - cx) + (ax - cx) * (py - cy)) / F.nullif(det, F.lit(0.0))
    return F.coalesce((u >= -1e-9) & (v >= -1e-9) & (u + v <= 1 + 1e-9), F.lit(False))


def clamp(x: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.least(x, F.lit(hi)), F.lit(lo))


def smooth_step(t: Column) -> Column:
    t = clamp(t, 0.0, 1.0)
    return t * t * (3 - 2 * t)


def luma(r: Column, g: Column, b: Column) -> Column:
    return 0.2126 * r + 0.7152 * g + 0.0722 * b


def matrix_from_quaternion(q: Column) -> Column:
    """Row-major 3x3 rotation of a unit quaternion (x, y, z, w)."""
    x, y, z, w = (F.get(q, i) for i in range(4))
    double = lambda a, b, c, d: 2 * (a * b + c * d)
    return F.array(1 - double(y, y, z, z), double(x, y, -z, w), double(x, z, y, w), double(x, y, z, w), 1 - double(x, x, z, z), double(y, z, -x, w), double(x, z, -y, w), double(y, z, x, w), 1 - double(x, x, y, y))


def axis_smoke(x: Column, y: Column, z: Column, pitch: Column, yaw: Column, roll: Column, f: Column, cx: Column, cy: Column) -> Column:
    """A point straight ahead lands on the image centre, one ahead and right to its right, one ahead and up above it."""
    b = basis(pitch, yaw, roll)
    m = camera_to_world(x, y, z, pitch, yaw, roll)
    at = lambda *ways: project(m, *[p / 100 + sum((10 * b[w][i] for w in ways), F.lit(0.0)) for i, p in enumerate((x, y, z))], f, cx, cy)
    ahead, right, up = at("forward"), at("forward", "right"), at("forward", "up")
    ok = (F.abs(F.get(ahead, 0) - cx) < 0.01) & (F.abs(F.get(ahead, 1) - cy) < 0.01) & (F.get(right, 0) > cx + 1) & (F.get(up, 1) < cy - 1)
    return F.coalesce(ok, F.lit(False))
