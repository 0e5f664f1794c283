"""Column builders for scene geometry.

World: Z up, ground parallel to XY. Camera: X right, Y down, Z forward; a pose maps camera to world.
A camera is a position and three world axes (the columns of its rotation): right, down, forward. A
box is centre, size and three angles (a, b, c) with rotation Ry(c) Rx(b) Rz(a). All builders are
plain expressions, so they stay inside generated code and can be pushed and pruned like any other.
"""

import math
from decimal import Decimal, localcontext
from fractions import Fraction
from functools import reduce
from operator import add
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of the eight 45-degree sectors, clockwise from straight ahead.
OCTANTS = ("Front", "Front-Right", "Right", "Back-Right", "Back", "Back-Left", "Left", "Front-Left")
#: Directions on a grid whose rows grow downwards, from +X towards +Y.
FACINGS = ("right", "down-right", "down", "down-left", "left", "up-left", "up", "up-right")
#: Compass directions, clockwise from +Y.
COMPASS = ("north", "northeast", "east", "southeast", "south", "southwest", "west", "northwest")


class Vec(NamedTuple):
    x: Column
    y: Column
    z: Column

    def __sub__(self, other: "Vec") -> "Vec":
        return Vec(*(a - b for a, b in zip(self, other)))


class Camera(NamedTuple):
    at: Vec
    right: Vec
    down: Vec
    forward: Vec


def vec(name: str) -> Vec:
    """Columns name_x, name_y, name_z."""
    return Vec(*(F.col(f"{name}_{c}") for c in "xyz"))


def camera(prefix: str = "") -> Camera:
    return Camera(vec(f"{prefix}pos"), vec(f"{prefix}right"), vec(f"{prefix}down"), vec(f"{prefix}fwd"))


def total(columns: list[Column]) -> Column:
    return reduce(add, columns)


def dot(a: Vec, b: Vec) -> Column:
    return a.x * b.x + a.y * b.y + a.z * b.z


def norm(*parts: Column) -> Column:
    return F.sqrt(total([p * p for p in parts]))


def unit_clip(c: Column) -> Column:
    """Into [-1, 1], for acos and asin."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c))


def to_camera(c: Camera, p: Vec) -> Vec:
    """World point in camera coordinates (rigid inverse of the pose)."""
    d = p - c.at
    return Vec(dot(d, c.right), dot(d, c.down), dot(d, c.forward))


def to_world(c: Camera, p: Vec) -> Vec:
    return Vec(*(at + r * p.x + d * p.y + f * p.z for at, r, d, f in zip(c.at, c.right, c.down, c.forward)))


def project(p: Vec, fx: Column, fy: Column, cx: Column, cy: Column) -> tuple[Column, Column]:
    """Pixel of a camera-frame point; null at depth 0."""
    z = F.when(p.z != 0, p.z)
    return fx * p.x / z + cx, fy * p.y / z + cy


def back_project(u: Column, v: Column, d: Column, fx: Column, fy: Column, cx: Column, cy: Column) -> Vec:
    """Camera-frame point of a pixel and its depth; depth 0 gives the origin."""
    return Vec((u - cx) * d / fx, (v - cy) * d / fy, d)


def rotation_angle(a: Camera, b: Camera) -> Column:
    """Degrees of the rotation between two cameras."""
    trace = total([x * y for u, v in ((a.right, b.right), (a.down, b.down), (a.forward, b.forward)) for x, y in zip(u, v)])
    return F.degrees(F.acos(unit_clip((trace - 1) / 2)))


def distance(a: Vec, b: Vec) -> Column:
    return norm(*(a - b))


def ground_offset(c: Camera, p: Vec) -> tuple[Column, Column]:
    """(dx, dz): right and forward offset of a world point on the ground plane of a camera.

    A camera that looks straight up or down has no ground axes; then its own frame serves.
    """
    d = p - c.at
    fn, rn = norm(c.forward.x, c.forward.y), norm(c.right.x, c.right.y)
    flat = (fn < 1e-6) | (rn < 1e-6)
    own = to_camera(c, p)
    some = lambda n: F.when(flat, F.lit(1.0)).otherwise(n)
    dx = F.when(flat, own.x).otherwise((d.x * c.right.x + d.y * c.right.y) / some(rn))
    dz = F.when(flat, own.z).otherwise((d.x * c.forward.x + d.y * c.forward.y) / some(fn))
    return dx, dz


def ground_frame(c: Camera) -> tuple[tuple[Vec, Column], tuple[Vec, Column]]:
    """(axis, length) to the right and forward: an offset's product with the axis, over the length, is
    ground_offset's dx or dz to the last bit. They are a camera's own, so they are worked out once a view
    and not once a pair."""
    fn, rn = norm(c.forward.x, c.forward.y), norm(c.right.x, c.right.y)
    flat = (fn < 1e-6) | (rn < 1e-6)
    frame = lambda v, n: (Vec(v.x, v.y, F.when(flat, v.z).otherwise(0.0)), F.when(flat, F.lit(1.0)).otherwise(n))
    return frame(c.right, rn), frame(c.forward, fn)


def ground_axes(c: Camera) -> tuple[Vec, Vec]:
    """ground_frame's axes over their lengths."""
    (right, rn), (ahead, fn) = ground_frame(c)
    return Vec(*(x / rn for x in right)), Vec(*(x / fn for x in ahead))


def bearing(dx: Column, dz: Column) -> Column:
    """Degrees clockwise from straight ahead, in (-180, 180]."""
    return F.degrees(F.atan2(dx, dz))


def _thirds(angle: Fraction) -> tuple[list[float], list[float]]:
    """Sine and cosine of an angle, each as three doubles; the first two have 24 bits."""
    with localcontext() as c:
        c.prec = 60
        x = Decimal(angle.numerator) / Decimal(angle.denominator)
        term, sums = Decimal(1), [Decimal(0), Decimal(0)]
        for i in range(80):
            sums[(i + 1) % 2] += term * (1, 1, -1, -1)[i % 4]
            term = term * x / (i + 1)
        out = []
        for s in sums:
            parts: list[float] = []
            for _ in range(2):
                m, e = math.frexp(float(s - sum(map(Decimal, parts))))
                parts.append(math.ldexp(round(m * 2**24), e - 24))
            out.append([*parts, float(s - sum(map(Decimal, parts)))])
    return out[0], out[1]


def off_axis(dx: Column, dz: Column, degrees: float) -> Column:
    """Whether a bearing is at least `degrees` (above 0, below 180) to either side, of the correctly rounded
    arc tangent: the engine's own may be off by a last bit, which decides where the bearing is the bound.

    Near the bound the sign of |dx| cos m - dz sin m tells, m lying half a bit below the smallest angle that
    counts; all its large products are exact.
    """
    least = math.radians(degrees)
    while math.degrees(least) >= degrees:
        least = math.nextafter(least, 0.0)
    while math.degrees(least) < degrees:
        least = math.nextafter(least, math.inf)
    sin, cos = _thirds((Fraction(least) + Fraction(math.nextafter(least, 0.0))) / 2)
    x, z = F.abs(dx), dz
    xh, zh = (v.cast("float").cast("double") for v in (x, z))
    xl, zl = x - xh, z - zh
    part = lambda i: (xh * cos[i] - zh * sin[i], xl * cos[i] - zl * sin[i])
    side = part(0)[0] + ((part(0)[1] + part(1)[0]) + (part(1)[1] + part(2)[0]))
    angle = F.abs(bearing(dx, dz))
    return F.when(F.abs(angle - degrees) < 1e-9, side >= 0).otherwise(angle >= degrees)


def sector(angle: Column, names: tuple[str, ...]) -> Column:
    """Name of the 45-degree sector, centred on multiples of 45, that holds an angle in degrees."""
    i = F.floor(F.pmod(angle + 22.5, F.lit(360.0)) / 45.0).cast("int")
    return F.element_at(F.array(*map(F.lit, names)), F.least(i, F.lit(7)) + 1)


def octant(dx: Column, dz: Column) -> Column:
    return sector(bearing(dx, dz), OCTANTS)


def clear_of_bounds(dx: Column, dz: Column, margin: float) -> Column:
    """Whether a bearing keeps `margin` degrees from the bounds of its octant (margin 22.4 at most)."""
    if margin <= 0:
        return F.lit(True)
    off = ((bearing(dx, dz) + 22.5) % 45.0 + 45.0) % 45.0 - 22.5
    return (F.abs(off) <= 22.5 - min(margin, 22.4)) | ((F.abs(dx) < 1e-6) & (F.abs(dz) < 1e-6))


def degenerate(dx: Column, dz: Column) -> Column:
    return (F.abs(dx) < 0.05) & (F.abs(dz) < 0.05)


def box_axes(prefix: str = "") -> tuple[Vec, Vec, Vec]:
    """Rotation of a box as its three columns, from columns sin/cos of e0, e1, e2 (see with_trig)."""
    sa, sb, sc, ca, cb, cc = (F.col(f"{prefix}{f}{i}") for f in ("s", "c") for i in range(3))
    return (
        Vec(cc * ca + sc * sb * sa, cb * sa, -sc * ca + cc * sb * sa),
        Vec(-cc * sa + sc * sb * ca, cb * ca, sc * sa + cc * sb * ca),
        Vec(sc * cb, -sb, cc * cb),
    )


def trig(prefix: str = "", angles: tuple[str, ...] = ("e0", "e1", "e2")) -> list[Column]:
    """Sine and cosine columns of box angles, projected once so that products of them stay small."""
    return [f(F.col(f"{prefix}{a}")).alias(f"{prefix}{n}{i}") for n, f in (("s", F.sin), ("c", F.cos)) for i, a in enumerate(angles)]


def angles_of(x: Vec, y: Vec, z: Vec) -> tuple[Column, Column, Column]:
    """(a, b, c) of a rotation given by its columns."""
    return F.atan2(x.y, y.y), F.asin(unit_clip(-z.y)), F.atan2(z.x, z.z)


def folded(angle: Column, digits: int = 6) -> Column:
    """Rounded, with -pi read as pi: the two are one direction."""
    r = F.round(angle, digits)
    return F.when(r <= F.round(F.lit(-3.141592653589793), digits), F.round(F.lit(3.141592653589793), digits)).otherwise(r)


#: Signs of the eight corners of a box.
CORNERS = tuple((x, y, z) for x in (-1, 1) for y in (-1, 1) for z in (-1, 1))


def corners(centre: Vec, size: Vec, axes: tuple[Vec, Vec, Vec]) -> list[Vec]:
    return [Vec(*(c + sx * size.x / 2 * x + sy * size.y / 2 * y + sz * size.z / 2 * z for c, x, y, z in zip(centre, *axes))) for sx, sy, sz in CORNERS]


def in_box(p: Vec, centre: Vec, size: Vec, axes: tuple[Vec, Vec, Vec], scale: float = 1.0) -> Column:
    """Whether a point is within an oriented box whose sizes are scaled."""
    d = p - centre
    return (F.abs(dot(d, axes[0])) <= size.x * scale / 2) & (F.abs(dot(d, axes[1])) <= size.y * scale / 2) & (F.abs(dot(d, axes[2])) <= size.z * scale / 2)


def fov_degrees(width: Column, fx: Column) -> Column:
    return F.degrees(2 * F.atan2(width.cast("double"), 2 * fx))


def compare(a: Column, b: Column, tolerance: float, less: str, more: str, equal: str = "equal") -> Column:
    """Three-way answer: equal if the two differ by less than the tolerance."""
    d = F.abs(a - b)
    # Nine digits only matter near the tolerance; rounding is the costly part.
    same = F.when(F.abs(d - tolerance) > 1e-8, d < tolerance).otherwise(F.abs(F.round(a - b, 9)) < tolerance)
    return F.when(same, equal).when(a < b, less).otherwise(more)


def compass(dx: Column, dy: Column, delta: float = 15.0, names: tuple[str, ...] = COMPASS) -> Column:
    """Eight-way direction, 0 degrees along +Y; the four main ones are 2*delta wide."""
    a = F.degrees(F.atan2(dx, dy))
    main = lambda at: (a > at - delta) & (a <= at + delta)
    return (
        F.when(main(0), names[0])
        .when((a > delta) & (a <= 90 - delta), names[1])
        .when(main(90), names[2])
        .when((a > 90 + delta) & (a <= 180 - delta), names[3])
        .when((a > 180 - delta) | (a <= -180 + delta), names[4])
        .when((a > -180 + delta) & (a <= -90 - delta), names[5])
        .when(main(-90), names[6])
        .otherwise(names[7])
    )


def turned(dx: Column, dy: Column, degrees: Column) -> tuple[Column, Column]:
    """A ground vector turned counter-clockwise."""
    r = F.radians(degrees)
    return dx * F.cos(r) - dy * F.sin(r), dx * F.sin(r) + dy * F.cos(r)


#: Euler conventions over rotation matrices: axis order -> (first, second, third) as in R = A B C.
CONVENTIONS = tuple(a + b + c for a in "XYZ" for b in "XYZ" if b != a for c in "XYZ" if c != b)


def euler(m: list[list[Column]], convention: str) -> tuple[Column, Column, Column]:
    """Angles of m = R_i(p) R_j(q) R_k(r) for any of the twelve CONVENTIONS, intrinsic."""
    i, j, k = ("XYZ".index(c) for c in convention)
    odd = (j - i) % 3 == 2
    s = -1.0 if odd else 1.0
    if i == k:  # proper: the third axis is the first again
        o = 3 - i - j
        return F.atan2(m[j][i], -s * m[o][i]), F.acos(unit_clip(m[i][i])), F.atan2(m[i][j], s * m[i][o])
    return F.atan2(-s * m[j][k], m[k][k]), F.asin(unit_clip(s * m[i][k])), F.atan2(-s * m[i][j], m[i][i])


#: Columns of a rendered camera's axes that change sign, and the length unit's factor is its own.
FLIP = (1.0, -1.0, -1.0)


def flipped(axes: list[Vec], at: Vec, scale: Column) -> tuple[list[Vec], Vec]:
    """A rendered camera's axes (right, up, back) as right, down, forward, and its place in metres."""
    return [Vec(*(c * s for c in a)) for a, s in zip(axes, map(F.lit, FLIP))], Vec(*(c * scale for c in at))
