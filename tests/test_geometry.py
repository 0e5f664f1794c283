"""Geometry builders against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vistaloom.functions import geometry as g


def rotation(a, b, c):
    rz = np.array([[math.cos(a), -math.sin(a), 0], [math.sin(a), math.cos(a), 0], [0, 0, 1]])
    rx = np.array([[1, 0, 0], [0, math.cos(b), -math.sin(b)], [0, math.sin(b), math.cos(b)]])
    ry = np.array([[math.cos(c), 0, math.sin(c)], [0, 1, 0], [-math.sin(c), 0, math.cos(c)]])
    return ry @ rx @ rz


def camera_rows(yaw, pitch, at):
    sy, cy, sp, cp = math.sin(yaw), math.cos(yaw), math.sin(pitch), math.cos(pitch)
    return (*map(float, at), sy, -cy, 0.0, sp * cy, sp * sy, -cp, cp * cy, cp * sy, sp)


NAMES = [f"{a}_{c}" for a in ("pos", "right", "down", "fwd") for c in "xyz"]


def lit_camera(row):
    v = [F.lit(x) for x in row]
    return g.Camera(*(g.Vec(*v[i : i + 3]) for i in (0, 3, 6, 9)))


def one(spark, *columns):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


@pytest.fixture(scope="module")
def boxes(spark):
    rng = np.random.default_rng(1)
    rows = [tuple(map(float, r)) for r in np.column_stack([rng.uniform(-5, 5, (40, 3)), rng.uniform(0.1, 3, (40, 3)), rng.uniform(-3, 3, 40), rng.uniform(-1.5, 1.5, 40), rng.uniform(-3, 3, 40)])]
    rows += [(0.0, 0.0, 0.0, 1.0, 2.0, 3.0, math.pi / 2, 0.0, 0.0), (0.0, 0.0, 0.0, 1.0, 2.0, 3.0, 0.0, math.pi / 2, 0.0), (0.0, 0.0, 0.0, 1.0, 2.0, 3.0, 0.0, 0.0, math.pi / 2)]
    df = spark.createDataFrame(rows, "c_x double, c_y double, c_z double, l_x double, l_y double, l_z double, e0 double, e1 double, e2 double")
    return rows, df.select("*", *g.trig())


def test_corners_and_angles(boxes):
    rows, df = boxes
    axes = g.box_axes()
    out = df.select(F.array(*[x for p in g.corners(g.vec("c"), g.vec("l"), axes) for x in p]).alias("p"), F.array(*g.angles_of(*axes)).alias("e")).collect()
    for r, o in zip(rows, out):
        m = rotation(*r[6:])
        want = [np.array(s) * np.array(r[3:6]) / 2 @ m.T + r[:3] for s in g.CORNERS]
        assert np.allclose(np.array(o.p).reshape(8, 3), want, atol=1e-9)
        if abs(r[7]) < 1.55:
            assert np.allclose(rotation(*o.e), m, atol=1e-9)


def test_containment(boxes):
    rows, df = boxes
    rng = np.random.default_rng(2)
    for q in rng.uniform(-3, 3, (5, 3)):
        got = [r[0] for r in df.select(g.in_box(g.Vec(*map(F.lit, map(float, q))), g.vec("c"), g.vec("l"), g.box_axes(), 0.9)).collect()]
        want = [bool((np.abs((q - r[:3]) @ rotation(*r[6:])) <= np.array(r[3:6]) * 0.45).all()) for r in rows]
        assert got == want


def test_round_trips(spark):
    c = lit_camera(camera_rows(0.7, -0.2, (1, 2, 3)))
    p = g.Vec(F.lit(0.3), F.lit(-0.4), F.lit(2.5))
    assert one(spark, *g.to_camera(c, g.to_world(c, p))) == pytest.approx((0.3, -0.4, 2.5))
    k = [F.lit(x) for x in (50.0, 60.0, 32.0, 24.0)]
    u, v = g.project(p, *k)
    assert one(spark, *g.back_project(u, v, F.lit(2.5), *k)) == pytest.approx((0.3, -0.4, 2.5))


@pytest.mark.parametrize("pitch", [0, 20, -20])
def test_compass_of_cameras(spark, pitch):
    a = lit_camera(camera_rows(0, math.radians(pitch), (0, 0, 1)))
    for i, name in enumerate(g.OCTANTS):
        w = -math.radians(45 * i)
        dx, dz = g.ground_offset(a, g.Vec(F.lit(2 * math.cos(w)), F.lit(2 * math.sin(w)), F.lit(1.0)))
        assert one(spark, g.octant(dx, dz), g.clear_of_bounds(dx, dz, 5.0)) == (name, True)
    for off, clear in ((22.5 - 4.9, False), (22.5 + 4.9, False), (22.5 - 5.1, True), (22.5 + 5.1, True)):
        w = -math.radians(off)
        dx, dz = g.ground_offset(a, g.Vec(F.lit(2 * math.cos(w)), F.lit(2 * math.sin(w)), F.lit(1.0)))
        assert one(spark, g.clear_of_bounds(dx, dz, 5.0)) == (clear,)


def test_upright_camera_falls_back(spark):
    a = lit_camera((0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0))
    assert one(spark, *g.ground_offset(a, g.Vec(F.lit(1.0), F.lit(2.0), F.lit(3.0)))) == (1.0, 3.0)


def test_rotation_angle_and_fov(spark):
    a, b = lit_camera(camera_rows(0.1, 0, (0, 0, 0))), lit_camera(camera_rows(0.1 + math.radians(40), 0, (0, 0, 0)))
    assert one(spark, g.rotation_angle(a, b), g.rotation_angle(a, a), g.fov_degrees(F.lit(100), F.lit(50.0))) == pytest.approx((40, 0, 90), abs=1e-5)


@pytest.mark.parametrize("convention", g.CONVENTIONS)
def test_euler_conventions(spark, convention):
    def turn(axis, t):
        i = "XYZ".index(axis)
        m, j, k = np.eye(3), (i + 1) % 3, (i + 2) % 3
        m[j, j] = m[k, k] = math.cos(t)
        m[j, k], m[k, j] = -math.sin(t), math.sin(t)
        return m

    m = turn(convention[0], 0.4) @ turn(convention[1], 0.7) @ turn(convention[2], -1.1)
    got = one(spark, *g.euler([[F.lit(float(x)) for x in r] for r in m], convention))
    back = turn(convention[0], got[0]) @ turn(convention[1], got[1]) @ turn(convention[2], got[2])
    assert np.allclose(back, m, atol=1e-9)


def test_branch_cut_and_compare(spark):
    assert one(spark, g.folded(F.lit(-math.pi)), g.folded(F.lit(math.pi)), g.folded(F.lit(1.0))) == (3.141593, 3.141593, 1.0)
    assert one(spark, *[g.compare(F.lit(1.0), F.lit(x), 0.3, "B", "C") for x in (1.1, 2.0, 0.5)]) == ("equal", "B", "C")


def test_compass_words(spark):
    for angle, word in ((0, "north"), (15, "north"), (15.1, "northeast"), (90, "east"), (164, "southeast"), (180, "south"), (-166, "south"), (-90, "west"), (-20, "northwest")):
        r = math.radians(angle)
        assert one(spark, g.compass(F.lit(math.sin(r)), F.lit(math.cos(r)), 15.0 + 1e-9)) == (word,)


def test_ground_axes_give_the_ground_offset(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(200):
        q = np.linalg.qr(rng.normal(size=(3, 3)))[0]
        if k < 3:
            q = np.array([[1.0, 0, 0], [0, 1, 0], [0, 0, 1]]) if k == 0 else np.array([[1.0, 0, 0], [0, -1, 0], [0, 0, -1]])  # straight up or down
        rows.append([*map(float, rng.normal(size=3)), *map(float, q.T.ravel()), *map(float, rng.normal(size=3))])
    names = [f"{n}_{k}" for n in ("pos", "right", "down", "fwd", "p") for k in "xyz"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    c = g.camera()
    right, ahead = g.ground_axes(c)
    d = g.vec("p") - c.at
    dx, dz = g.ground_offset(c, g.vec("p"))
    for r in df.select(dx.alias("a"), dz.alias("b"), g.dot(d, right).alias("c"), g.dot(d, ahead).alias("d")).collect():
        assert (r.a, r.b) == pytest.approx((r.c, r.d), abs=1e-12)


def test_a_bearing_on_the_bound_counts_as_correctly_rounded(spark):
    """Java's arc tangent of the first is a bit short of 30 degrees; the correctly rounded one is not."""
    x, z = -3.6062445840513924, 6.246198844097104
    rows = [(x, z), (-x, z), (x, math.nextafter(z, 9.0)), (x, math.nextafter(z, 0.0)), (1.0, 1.0), (0.5, 1.0), (1.0, -1.0)]
    df = spark.createDataFrame(rows, "dx double, dz double").repartition(1)
    want = [abs(math.degrees(math.atan2(x, z))) >= 30 for x, z in rows]
    assert want == [True, True, False, True, True, False, True]
    assert [r.far for r in df.select(g.off_axis(F.col("dx"), F.col("dz"), 30.0).alias("far"), "dz").collect()] == want
    assert one(spark, g.off_axis(F.lit(1.0), F.lit(-1.0), 135.0), g.off_axis(F.lit(1.0), F.lit(-1.0), 136.0)) == (True, False)
