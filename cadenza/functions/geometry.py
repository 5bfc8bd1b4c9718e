"""Plane geometry as column expressions.  Points are structs with x and y; y grows downward."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import KP

#: Mass share and place of the centre along each body segment (fixed values: Winter 2009, table 4.1).
SEGMENTS = {
    "head": (0.081, None),
    "trunk": (0.497, 0.45),
    "uarm": (0.028, 0.436),
    "farm": (0.016, 0.682),
    "hand": (0.006, 1.0),
    "thigh": (0.100, 0.433),
    "shank": (0.0465, 0.433),
    "foot": (0.0145, 1.0),
}
#: Joint at the corner, and the two around it, of each angle of the left side.
ANGLES = {"el": ("sho", "el", "wr"), "sho": ("el", "sho", "hip"), "hip": ("sho", "hip", "knee"), "knee": ("hip", "knee", "ank")}
BONES = ((5, 6), (5, 7), (7, 9), (6, 8), (8, 10), (5, 11), (6, 12), (11, 12), (11, 13), (13, 15), (12, 14), (14, 16))
EPS = 1e-9


def point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def dist(a: Column, b: Column) -> Column:
    return F.hypot(a["x"] - b["x"], a["y"] - b["y"])


def mid(a: Column, b: Column) -> Column:
    return point((a["x"] + b["x"]) / 2, (a["y"] + b["y"]) / 2)


def cross(a: Column, b: Column, p: Column) -> Column:
    """Twice the signed area of a, b, p."""
    return (b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"])


def angle_at(a: Column, b: Column, c: Column) -> Column:
    """Degrees at b between a and c."""
    dot = (a["x"] - b["x"]) * (c["x"] - b["x"]) + (a["y"] - b["y"]) * (c["y"] - b["y"])
    cosine = dot / F.greatest(dist(a, b) * dist(c, b), F.lit(EPS))
    return F.degrees(F.acos(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0))))


def joint(kpts: Column, name: str) -> Column:
    return F.get(kpts, F.lit(KP[name]))


def joint_angles(kpts: Column) -> dict[str, Column]:
    """The eight angles by name: elbow, shoulder, hip and knee of either side."""
    return {f"{s}{name}": angle_at(*(joint(kpts, f"{s}{j}") for j in around)) for name, around in ANGLES.items() for s in "lr"}


def com_weights() -> list[float]:
    """The centre of mass is linear in the joints: one weight each."""
    out = [0.0] * len(KP)

    def add(mass: float, place: float, near: list[str], far: list[str]) -> None:
        for names, share in ((near, 1 - place), (far, place)):
            for n in names:
                out[KP[n]] += mass * share / len(names)

    for s in "lr":
        for part, near, far in (("uarm", "sho", "el"), ("farm", "el", "wr"), ("hand", "wr", "wr"), ("thigh", "hip", "knee"), ("shank", "knee", "ank"), ("foot", "ank", "ank")):
            add(*SEGMENTS[part], [s + near], [s + far])
    add(*SEGMENTS["trunk"], ["lhip", "rhip"], ["lsho", "rsho"])
    add(SEGMENTS["head"][0], 1.0, ["lear"], ["lear", "rear"])
    total = sum(out)
    return [w / total for w in out]


def com(kpts: Column) -> Column:
    """Whole-body centre of mass."""
    weights = F.array(*map(F.lit, com_weights()))

    def along(axis: str) -> Column:
        return F.aggregate(F.zip_with(kpts, weights, lambda p, w: p[axis] * w), F.lit(0.0), lambda a, v: a + v)

    return point(along("x"), along("y"))


def barycentric(p: Column, a: Column, b: Column, c: Column) -> tuple[Column, Column, Column]:
    """Weights of b and c at p, and whether the triangle has an area."""
    bx, by, cx, cy, px, py = b["x"] - a["x"], b["y"] - a["y"], c["x"] - a["x"], c["y"] - a["y"], p["x"] - a["x"], p["y"] - a["y"]
    d00, d01, d11, d20, d21 = bx * bx + by * by, bx * cx + by * cy, cx * cx + cy * cy, px * bx + py * by, px * cx + py * cy
    den = d00 * d11 - d01 * d01
    return F.try_divide(d11 * d20 - d01 * d21, den), F.try_divide(d00 * d21 - d01 * d20, den), F.abs(den) >= EPS


def in_triangle(p: Column, a: Column, b: Column, c: Column) -> Column:
    """Whether p is inside (edges included); a triangle without area holds nothing."""
    u, v, proper = barycentric(p, a, b, c)
    return F.when(proper, (u >= 0) & (v >= 0) & (u + v <= 1)).otherwise(F.lit(False))


def line_dist(p: Column, a: Column, b: Column) -> Column:
    return F.abs(cross(a, b, p)) / F.greatest(dist(a, b), F.lit(EPS))


def triangle_margin(p: Column, a: Column, b: Column, c: Column) -> Column:
    """Least distance to the three edge lines, without sign; 0 without area."""
    _, _, proper = barycentric(p, a, b, c)
    return F.when(proper, F.least(line_dist(p, a, b), line_dist(p, b, c), line_dist(p, c, a))).otherwise(F.lit(0.0))


def segment_dist(p: Column, a: Column, b: Column) -> Column:
    """Distance to the segment from a to b."""
    ux, uy = b["x"] - a["x"], b["y"] - a["y"]
    length2 = ux * ux + uy * uy
    along = F.least(F.greatest(F.try_divide((p["x"] - a["x"]) * ux + (p["y"] - a["y"]) * uy, length2), F.lit(0.0)), F.lit(1.0))
    return F.when(F.sqrt(length2) < EPS, dist(p, a)).otherwise(F.hypot(p["x"] - a["x"] - along * ux, p["y"] - a["y"] - along * uy))


def in_rect(p: Column, rect: tuple[Column, ...]) -> Column:
    x0, y0, x1, y1 = rect
    return p["x"].between(x0, x1) & p["y"].between(y0, y1)


def _left(ax, ay, bx, by, cx, cy) -> Column:
    return (cy - ay) * (bx - ax) > (by - ay) * (cx - ax)


def segment_in_rect(p: Column, q: Column, rect: tuple[Column, ...]) -> Column:
    """Whether the segment from p to q meets the rectangle x0, y0, x1, y1."""
    x0, y0, x1, y1 = rect
    apart = (F.greatest(p["x"], q["x"]) < x0) | (F.least(p["x"], q["x"]) > x1) | (F.greatest(p["y"], q["y"]) < y0) | (F.least(p["y"], q["y"]) > y1)
    crossed = F.lit(False)
    for rx, ry, sx, sy in ((x0, y0, x1, y0), (x1, y0, x1, y1), (x1, y1, x0, y1), (x0, y1, x0, y0)):
        a = _left(p["x"], p["y"], rx, ry, q["x"], q["y"]) != _left(p["x"], p["y"], sx, sy, q["x"], q["y"])
        b = _left(rx, ry, p["x"], p["y"], sx, sy) != _left(rx, ry, q["x"], q["y"], sx, sy)
        crossed = crossed | (a & b)
    return ~apart & (in_rect(p, rect) | in_rect(q, rect) | crossed)


def body_in_rect(kpts: Column, rect: tuple[Column, ...]) -> Column:
    """Whether a joint lies in, or a bone crosses, the rectangle; null without any joint."""
    known = F.filter(kpts, lambda p: p["x"].isNotNull())
    bones = F.array(*[F.struct(F.get(kpts, F.lit(a)).alias("p"), F.get(kpts, F.lit(b)).alias("q")) for a, b in BONES])
    hit = F.exists(known, lambda p: in_rect(p, rect)) | F.exists(bones, lambda b: F.coalesce(segment_in_rect(b["p"], b["q"], rect), F.lit(False)))
    return F.when(F.coalesce(F.size(known), F.lit(0)) > 0, hit)


def hip_mid(kpts: Column, least: float = 0.3) -> Column:
    """Middle of the hips, where both are surer than ``least``."""
    left, right = joint(kpts, "lhip"), joint(kpts, "rhip")
    return F.when((left["c"] > least) & (right["c"] > least), mid(left, right))


def box_area(box: Column) -> Column:
    return (F.get(box, F.lit(2)) - F.get(box, F.lit(0))) * (F.get(box, F.lit(3)) - F.get(box, F.lit(1)))
