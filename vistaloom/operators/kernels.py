"""Numeric kernels that SQL cannot express, and the place where models and renderers plug in.

Kernels run on Arrow batches, one group or a few rows at a time; what they see is bounded by an object,
a box or an image.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from . import graph, tables


def hull_volume(points: np.ndarray, eps: float = 1e-9) -> float:
    """Volume of the convex hull of points (n, 3); 0 if they lie in a plane.

    Incremental: a point outside takes away the faces it sees and is joined to their outline.
    """
    p = np.unique(np.asarray(points, float), axis=0)
    if len(p) < 4:
        return 0.0
    p = p - p.mean(axis=0)
    scale = np.abs(p).max()
    if scale == 0:
        return 0.0
    p /= scale
    i = int(np.argmax(((p - p[0]) ** 2).sum(axis=1)))
    line = np.cross(p - p[0], p[i] - p[0])
    j = int(np.argmax((line**2).sum(axis=1)))
    normal = np.cross(p[i] - p[0], p[j] - p[0])
    off = (p - p[0]) @ normal
    k = int(np.argmax(np.abs(off)))
    if abs(off[k]) < eps:
        return 0.0
    inner = p[[0, i, j, k]].mean(axis=0)

    def face(a: int, b: int, c: int) -> tuple[int, int, int]:
        n = np.cross(p[b] - p[a], p[c] - p[a])
        return (a, b, c) if n @ (p[a] - inner) > 0 else (a, c, b)

    faces = {face(*f) for f in ((0, i, j), (0, i, k), (0, j, k), (i, j, k))}
    tri = np.array(sorted(faces))
    normals = np.cross(p[tri[:, 1]] - p[tri[:, 0]], p[tri[:, 2]] - p[tri[:, 0]])
    for q in range(len(p)):
        seen = ((p[q] - p[tri[:, 0]]) * normals).sum(axis=1) > eps
        if not seen.any():
            continue
        edges = {(int(t[a]), int(t[b])) for t in tri[seen] for a, b in ((0, 1), (1, 2), (2, 0))}
        new = np.array([(a, b, q) for a, b in edges if (b, a) not in edges])
        tri = np.concatenate([tri[~seen], new])
        normals = np.concatenate([normals[~seen], np.cross(p[new[:, 1]] - p[new[:, 0]], p[new[:, 2]] - p[new[:, 0]])])
    return float(np.einsum("ij,ij->i", p[tri[:, 0]], np.cross(p[tri[:, 1]], p[tri[:, 2]])).sum() / 6 * scale**3)


def hull_volumes(points: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_points, volume): convex hull of each group's points p_x, p_y, p_z."""
    schema = ", ".join(f"`{k}` {points.schema[k].dataType.simpleString()}" for k in keys)

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(*key, len(pdf), hull_volume(pdf[["p_x", "p_y", "p_z"]].to_numpy()))])

    return points.groupBy(*keys).applyInPandas(one, f"{schema}, n_points long, volume double")


def oriented_box(points: np.ndarray) -> np.ndarray:
    """Box of points (n, 3) along their main directions: centre, lengths and the angles of its axes, 9 numbers.

    Axes are the principal directions, the longest first, right-handed; points in one place give a box
    without size.
    """
    p = np.asarray(points, float)
    middle = p.mean(axis=0)
    axes = np.linalg.svd(p - middle, full_matrices=True)[2]
    if np.linalg.det(axes) < 0:
        axes[2] = -axes[2]
    at = (p - middle) @ axes.T
    low, high = at.min(axis=0), at.max(axis=0)
    centre, r = middle + (low + high) / 2 @ axes, axes.T
    return np.concatenate([centre, high - low, [np.arctan2(r[1, 0], r[1, 1]), np.arcsin(np.clip(-r[1, 2], -1, 1)), np.arctan2(r[0, 2], r[2, 2])]])


def oriented_boxes(points: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, box array<double>[9]) of each group's points p_x, p_y, p_z."""
    schema = ", ".join(f"`{k}` {points.schema[k].dataType.simpleString()}" for k in keys)

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(*key, oriented_box(pdf[["p_x", "p_y", "p_z"]].to_numpy()))])

    return points.groupBy(*keys).applyInPandas(one, f"{schema}, box array<double>")


def hull_2d(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull of points (n, 2), counter-clockwise."""
    p = sorted(map(tuple, np.asarray(points, float)))
    if len(p) < 3:
        return np.array(p)

    def half(ps):
        out: list[tuple[float, float]] = []
        for x in ps:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (x[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (x[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(x)
        return out[:-1]

    return np.array(half(p) + half(p[::-1]))


def area(polygon: np.ndarray) -> float:
    if len(polygon) < 3:
        return 0.0
    x, y = polygon[:, 0], polygon[:, 1]
    return float(abs(x @ np.roll(y, -1) - y @ np.roll(x, -1)) / 2)


def clipped(polygon: np.ndarray, width: float, height: float) -> np.ndarray:
    """A convex polygon's part within [0, width] x [0, height]."""
    for axis, bound, sign in ((0, 0.0, 1), (0, width, -1), (1, 0.0, 1), (1, height, -1)):
        if not len(polygon):
            break
        d = sign * (polygon[:, axis] - bound)
        out = []
        for a in range(len(polygon)):
            b = (a + 1) % len(polygon)
            if d[a] >= 0:
                out.append(polygon[a])
            if (d[a] >= 0) != (d[b] >= 0):
                out.append(polygon[a] + (polygon[b] - polygon[a]) * d[a] / (d[a] - d[b]))
        polygon = np.array(out).reshape(-1, 2)
    return polygon


#: Corners (of geometry.corners) of each of the six faces of a box.
FACES = [[i for i, signs in enumerate(g.CORNERS) if signs[axis] == side] for axis in range(3) for side in (-1, 1)]


def box_faces(corners: np.ndarray, fx: float, fy: float, cx: float, cy: float, near: float = 1e-4) -> list[np.ndarray]:
    """Image outlines of the faces of a box (8 camera-frame corners) that lie wholly before the camera; if
    all do, one outline: that of the corners, which the faces cover."""
    front = corners[:, 2] >= near
    z = np.where(front, corners[:, 2], 1.0)
    at = np.stack([fx * corners[:, 0] / z + cx, fy * corners[:, 1] / z + cy], axis=1)
    return [hull_2d(at)] if front.all() else [hull_2d(at[f]) for f in FACES if front[f].all()]


def shown_share(faces: list[np.ndarray], width: float, height: float) -> float:
    """Of the area that outlines cover together, the part within the image; 0 if they cover none."""
    whole = union_area(faces)
    return union_area([clipped(f, width, height) for f in faces]) / whole if whole > 0 else 0.0


def union_area(polygons: list[np.ndarray]) -> float:
    """Area covered by convex polygons (n, 2) together: vertical strips between all corners and crossings,
    and in each the lengths that the polygons cover, which change linearly there."""
    polygons = [p for p in polygons if area(p) > 0]
    if len(polygons) < 2:
        return area(polygons[0]) if polygons else 0.0
    edges = np.array([(*p[i], *p[(i + 1) % len(p)]) for p in polygons for i in range(len(p))])
    x = [edges[:, 0]]
    for i in range(len(edges)):
        ax, ay, bx, by = edges[i]
        cx, cy, dx, dy = edges[i + 1 :].T
        cross = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
        with np.errstate(divide="ignore", invalid="ignore"):
            t = ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / cross
            s = ((cx - ax) * (by - ay) - (cy - ay) * (bx - ax)) / cross
        hit = (cross != 0) & (t > 0) & (t < 1) & (s > 0) & (s < 1)
        x.append(ax + t[hit] * (bx - ax))
    x = np.unique(np.concatenate(x))
    total = 0.0
    for lo, hi in zip(x[:-1], x[1:]):
        mid, spans = (lo + hi) / 2, []
        for p in polygons:
            q = np.roll(p, -1, axis=0)
            over = ((p[:, 0] <= mid) & (q[:, 0] > mid)) | ((q[:, 0] <= mid) & (p[:, 0] > mid))
            if over.sum() >= 2:
                a, b = p[over], q[over]
                y = a[:, 1] + (b[:, 1] - a[:, 1]) * (mid - a[:, 0]) / (b[:, 0] - a[:, 0])
                spans.append((y.min(), y.max()))
        end = -np.inf
        for a, b in sorted(spans):
            total += (hi - lo) * max(0.0, b - max(a, end))
            end = max(end, b)
    return total


def box_visibility(seen: DataFrame, views: DataFrame, nodes: DataFrame, width: float, height: float, fx: float, fy: float, cx: float, cy: float, near: float = 1e-4) -> DataFrame:
    """(scene_id, view_idx, node_id, share): of the image area that a box's faces cover, the part within the
    image. Only faces whose corners all lie before the camera count; a box without such faces has share 0.
    """
    t = seen.join(views, ["scene_id", "view_idx"]).join(nodes, ["scene_id", "node_id"]).select("*", *g.trig())
    c = g.camera()
    ends = [g.to_camera(c, p) for p in g.corners(g.vec("c"), g.vec("l"), g.box_axes())]
    t = t.select("scene_id", "view_idx", "node_id", F.array(*[x for p in ends for x in p]).alias("corners"))

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [shown_share(box_faces(np.array(c, float).reshape(8, 3), fx, fy, cx, cy, near), width, height) for c in pdf["corners"]]
            yield pdf[["scene_id", "view_idx", "node_id"]].assign(share=out)

    return t.mapInPandas(go, "scene_id long, view_idx long, node_id long, share double")


def valid_boxes(points: DataFrame, boxes: DataFrame, key: str, scale: float = 0.9, least_points: int = 50, least_share: float = 0.07) -> DataFrame:
    """3-D box test: enough points inside the scaled box, and their hull fills enough of it."""
    b = boxes.select("*", *g.trig())
    p = points.join(b, key)
    p = p.where(g.in_box(g.vec("p"), g.vec("c"), g.vec("l"), g.box_axes(), scale)).select(key, "node_id", "p_x", "p_y", "p_z")
    v = hull_volumes(p, [key, "node_id"]).join(boxes.select(key, "node_id", F.abs(F.col("l_x") * F.col("l_y") * F.col("l_z")).alias("box_volume")), [key, "node_id"])
    share = F.col("volume") / F.when(F.col("box_volume") > 0, F.col("box_volume"))
    return v.withColumn("share", F.coalesce(share, F.lit(0.0))).withColumn("valid", (F.col("n_points") >= least_points) & (F.col("share") >= least_share))


def footprints_overlap(a: np.ndarray, b: np.ndarray, slack: float = 0.5) -> bool:
    """Whether two boxes' convex ground outlines (n, 2) meet or come within slack * longest edge."""
    gap = np.inf
    for p, q in ((a, b), (b, a)):
        for i in range(len(p)):
            s, e = p[i], p[(i + 1) % len(p)]
            d = e - s
            t = np.clip(((q - s) @ d) / max(d @ d, 1e-18), 0, 1)
            gap = min(gap, float(np.sqrt(((s + t[:, None] * d - q) ** 2).sum(axis=1)).min()))
    if _separate(a, b) or _separate(b, a):
        longest = max(np.sqrt(((x - np.roll(x, -1, axis=0)) ** 2).sum(axis=1)).max() for x in (a, b))
        return gap < slack * longest
    return True


def footprint_overlaps(nodes: DataFrame, slack: float = 0.5) -> DataFrame:
    """(scene_id, a_node_id, b_node_id): pairs of a scene's boxes, smaller id first, whose convex ground
    outlines meet or come within slack times the longest edge."""
    n = nodes.select("*", *g.trig())
    ends = g.corners(g.vec("c"), g.vec("l"), g.box_axes())
    sides = {f"{c}_{end}": f(*[getattr(p, c) for p in ends]) for c in "xy" for end, f in (("low", F.least), ("high", F.greatest))}
    n = n.select("scene_id", "node_id", F.array(*[x for p in ends for x in (p.x, p.y)]).alias("ring"), *[v.alias(k) for k, v in sides.items()])
    n = n.withColumn("across", g.norm(F.col("x_high") - F.col("x_low"), F.col("y_high") - F.col("y_low"))).repartition("scene_id")
    pairs = graph.prefixed(n, "a_", "scene_id").join(graph.prefixed(n, "b_", "scene_id"), "scene_id").where("a_node_id < b_node_id")
    # Outlines are as far apart as their upright rectangles at least, and no edge is longer than one's diagonal.
    apart = g.norm(*[F.greatest(F.lit(0.0), F.col(f"b_{c}_low") - F.col(f"a_{c}_high"), F.col(f"a_{c}_low") - F.col(f"b_{c}_high")) for c in "xy"])
    far = apart > F.greatest("a_across", "b_across") * (slack * 1.000001) + 1e-6
    pairs = pairs.where(F.isnan(apart) | ~far).select("scene_id", "a_node_id", "b_node_id", "a_ring", "b_ring")

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        outlines: dict[tuple, np.ndarray] = {}

        def outline(scene, node, ring) -> np.ndarray:
            if (scene, node) not in outlines:
                if len(outlines) > 50_000:
                    outlines.clear()
                outlines[scene, node] = hull_2d(np.array(ring, float).reshape(8, 2))
            return outlines[scene, node]

        for pdf in batches:
            near = [footprints_overlap(outline(s, i, p), outline(s, j, q), slack) for s, i, p, j, q in zip(pdf["scene_id"], pdf["a_node_id"], pdf["a_ring"], pdf["b_node_id"], pdf["b_ring"])]
            yield pdf.loc[near, ["scene_id", "a_node_id", "b_node_id"]]

    kind = {f.name: f.dataType.simpleString() for f in nodes.schema}
    return pairs.mapInPandas(go, f"scene_id {kind['scene_id']}, a_node_id {kind['node_id']}, b_node_id {kind['node_id']}")


def _separate(a: np.ndarray, b: np.ndarray) -> bool:
    for i in range(len(a)):
        d = a[(i + 1) % len(a)] - a[i]
        n = np.array([d[1], -d[0]])
        if (b @ n).min() > (a @ n).max() or (b @ n).max() < (a @ n).min():
            return True
    return False


def filtered_boxes(frames: DataFrame, pixels: DataFrame, tags: tuple[str, ...] = (), aligned: list[str] | None = None, width: int = 64, height: int = 48, least_area: float = 0.1, scale: float = 0.9, least_points: int = 50, least_share: float = 0.07, least_mask: float = 0.02) -> DataFrame:
    """The box filter: tags, then the box's outline in the image, then the depth points within it.

    frames: frame_id, the pose (pos_, right_, down_, fwd_), fx, fy, cx, cy, obj_tags and
    bboxes_3d_world_coords (lists). pixels: frame_id, u, v, d. A row keeps the places of all aligned lists
    (obj_tags, boxes, and `aligned`) whose boxes pass, and gets `masks`, for each of them the pixels
    (u, v) within its scaled box; rows left without any go. Cheap tests come first, so only boxes that
    pass them meet points.
    """
    lists = ["obj_tags", "bboxes_3d_world_coords", *(aligned or [])]
    kept = tables.without_tags(frames, tags, [c for c in lists if c != "obj_tags"]) if tags else frames.where(F.size("obj_tags") > 0)
    kept = kept.join(pixels.select("frame_id").distinct(), "frame_id", "left_semi")  # without depth nothing passes
    each = kept.select("frame_id", *[f"{n}_{c}" for n in ("pos", "right", "down", "fwd") for c in "xyz"], "fx", "fy", "cx", "cy", F.posexplode("bboxes_3d_world_coords").alias("place", "box"))
    names = ["c_x", "c_y", "c_z", "l_x", "l_y", "l_z", "e0", "e1", "e2"]
    each = each.where(F.size("box") == 9).select("*", *[F.get("box", F.lit(i)).alias(n) for i, n in enumerate(names)])
    boxes = each.select("frame_id", "place", *names)

    # Outline, with each frame's own intrinsics: the kernel works on unit cameras' coordinates.
    t = each.select("*", *g.trig())
    ends = [g.to_camera(g.camera(), p) for p in g.corners(g.vec("c"), g.vec("l"), g.box_axes())]
    t = t.select("frame_id", "place", "fx", "fy", "cx", "cy", F.array(*[x for p in ends for x in p]).alias("corners"))

    def outline(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            each = zip(pdf["corners"], pdf["fx"], pdf["fy"], pdf["cx"], pdf["cy"])
            good = [(s := shown_share(box_faces(np.array(c, float).reshape(8, 3), *k), width, height)) > 0 and s >= least_area for c, *k in each]
            yield pdf.loc[good, ["frame_id", "place"]]

    kind = frames.schema["frame_id"].dataType.simpleString()
    shown = t.mapInPandas(outline, f"frame_id {kind}, place int")
    # Points of the frame within the boxes that are left.
    b = boxes.join(shown, ["frame_id", "place"]).select("*", *g.trig())
    pose = kept.select("frame_id", *[f"{n}_{c}" for n in ("pos", "right", "down", "fwd") for c in "xyz"], "fx", "fy", "cx", "cy")
    p = pixels.join(pose, "frame_id")
    w = g.to_world(g.camera(), g.back_project(F.col("u"), F.col("v"), F.col("d"), F.col("fx"), F.col("fy"), F.col("cx"), F.col("cy")))
    p = p.select("frame_id", "u", "v", *[x.alias(f"p_{k}") for k, x in zip("xyz", w)])
    inside = p.join(b, "frame_id").where(g.in_box(g.vec("p"), g.vec("c"), g.vec("l"), g.box_axes(), scale)).select("frame_id", "place", "u", "v", "p_x", "p_y", "p_z")
    masks = inside.groupBy("frame_id", "place").agg(F.sort_array(F.collect_set(F.struct("v", "u"))).alias("mask"))  # pixels of one image
    v = hull_volumes(inside, ["frame_id", "place"]).join(masks, ["frame_id", "place"]).join(boxes.select("frame_id", "place", F.abs(F.col("l_x") * F.col("l_y") * F.col("l_z")).alias("box")), ["frame_id", "place"])
    good = v.where((F.col("n_points") >= least_points) & (F.col("box") > 0) & (F.col("volume") / F.when(F.col("box") > 0, F.col("box")) >= least_share) & (F.size("mask") / (width * height) >= least_mask))
    found = good.groupBy("frame_id").agg(F.sort_array(F.collect_list(F.struct("place", "mask"))).alias("__good"))  # boxes of one image
    out = kept.join(found, "frame_id")
    picked = lambda c: F.transform("__good", lambda x: F.get(F.col(c), x["place"]))
    at_places = {c: picked(c) for c in lists}
    return out.withColumns(at_places | {"masks": F.transform("__good", lambda x: x["mask"])}).drop("__good")


class Model:
    """A model or renderer as an operator: load() once a Python worker, then call() on pandas batches.

    Detectors, segmenters, captioners and drawing code subclass it; none of them is part of this
    package. The plan stays lazy, and the model never leaves the workers.
    """

    schema: str = ""

    def load(self) -> None:
        raise NotImplementedError(f"{type(self).__name__} is a plug-in: its model is not available here")

    def call(self, batch: pd.DataFrame) -> pd.DataFrame:
        raise NotImplementedError

    def apply(self, df: DataFrame) -> DataFrame:
        model = self

        def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model.load()
            for batch in batches:
                if len(batch):
                    yield model.call(batch)

        return df.mapInPandas(go, self.schema)


REGISTRY: dict[str, Callable[..., Model]] = {}


def register(name: str) -> Callable:
    def add(cls):
        REGISTRY[name] = cls
        return cls

    return add
