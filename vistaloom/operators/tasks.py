"""Spatial questions as tables: each function takes scene tables and gives subjects, measures and answer.

Candidate sets are whole: sampling is a separate step (sampling.py), seeded and repeatable.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.text import metric
from . import graph, sampling

#: Gates of camera pairs: rotation in degrees or distance, then ground distance and height difference, in metres.
PAIR = {"min_rotation": 15.0, "min_translation": 0.5, "min_horizontal": 0.3, "max_vertical": 0.3}
MARGIN = 5.0


def _admitted(pairs: DataFrame, a: g.Camera, b: g.Camera, gates: dict) -> DataFrame:
    high = gates["max_vertical"]
    return pairs.where(graph.ground_gates(a, b, gates["min_horizontal"], high) & graph.diverse(a, b, gates["min_rotation"], gates["min_translation"]))


def _grounded(views: DataFrame) -> DataFrame:
    """views with their ground frames, gr_ and gf_: before views are paired, so each is worked out once.

    Axes keep their length (gr_n, gf_n), by which products are divided: a bearing that is exactly a bound
    in ground_offset must not move off it by a last bit.
    """
    frame = zip(("gr", "gf"), g.ground_frame(g.camera()))
    return views.withColumns({f"{name}_{k}": x for name, (axis, n) in frame for k, x in zip("xyzn", (*axis, n))})


def _offset(df: DataFrame, c: g.Camera, p: g.Vec, prefix: str = "a_") -> DataFrame:
    d = p - c.at
    along = lambda name: g.dot(d, g.vec(f"{prefix}{name}")) / F.col(f"{prefix}{name}_n")
    return df.withColumn("dx", along("gr")).withColumn("dz", along("gf"))


def camera_movement(views: DataFrame, least: float = 0.2) -> DataFrame:
    """Main direction of the way from a scene's first to its last view, in the first one's frame."""
    at = F.struct(*[c for c in views.columns if c != "scene_id"])
    ends = views.groupBy("scene_id").agg(F.min_by(at, "view_idx").alias("a"), F.max_by(at, "view_idx").alias("b"), F.count("*").alias("n")).where("n >= 2")
    names = [c for c in views.columns if c != "scene_id"]
    ends = ends.select("scene_id", *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "ab" for c in names])
    move = g.to_camera(g.camera("a_"), g.camera("b_").at)
    out = ends.select("scene_id", F.col("a_view_idx").alias("start_view"), F.col("b_view_idx").alias("end_view"), move.z.alias("forward"), move.x.alias("rightward"))
    f, r = F.col("forward"), F.col("rightward")
    most = F.greatest(f, -f, r, -r)
    label = F.when(f == most, "Forward").when(-f == most, "Backward").when(r == most, "Right").otherwise("Left")
    return out.withColumn("answer", label).where(most >= least)


def camera_pair_octant(views: DataFrame, seen: DataFrame, gates: dict = PAIR, margin: float = MARGIN) -> DataFrame:
    """Where the second camera of a pair stands, seen from the first; a row for every node both see.

    Pairs are gated before their common nodes are listed; the one join is that of views with views.
    """
    a, b = g.camera("a_"), g.camera("b_")
    p = _admitted(graph.view_pairs(graph.with_node_lists(_grounded(views), seen)), a, b, gates)
    p = _offset(p, a, b.at).select("scene_id", "a_view_idx", "b_view_idx", "dx", "dz", F.array_intersect("a_nodes", "b_nodes").alias("nodes"))
    dx, dz = F.col("dx"), F.col("dz")
    p = p.where(~g.degenerate(dx, dz) & g.clear_of_bounds(dx, dz, margin)).withColumn("answer", g.octant(dx, dz))
    return p.select("scene_id", "a_view_idx", "b_view_idx", "dx", "dz", "answer", F.explode("nodes").alias("node_id"))


def camera_object(views: DataFrame, nodes: DataFrame, seen: DataFrame, variant: str, gates: dict = PAIR, margin: float = MARGIN, least: float = 0.3, min_bearing: float | None = None) -> DataFrame:
    """Where an object is from view a; "self": a sees it, "cross": a does not but b does.

    (scene_id, node_id, a_view_idx, b_view_idx, dx, dz, answer). min_bearing defaults to 30 degrees off
    the axis for "self" and to none for "cross".
    """
    wide = min_bearing if min_bearing is not None else 30.0 if variant == "self" else 0.0
    a, b = g.camera("a_"), g.camera("b_")
    pairs = _admitted(graph.view_pairs(views, ordered=False), a, b, gates)
    inside = nodes.where(~F.col("tag").isin(*graph.STRUCTURAL)).select("scene_id", "node_id", "c_x", "c_y", "c_z")
    at = graph.prefixed(_grounded(views), "a_", "scene_id")
    target = _offset(at.join(inside, "scene_id"), a, g.vec("c")).select("scene_id", "a_view_idx", "node_id", "dx", "dz")
    dx, dz = F.col("dx"), F.col("dz")
    target = target.where((g.norm(dx, dz) >= least) & ~g.degenerate(dx, dz) & g.clear_of_bounds(dx, dz, margin))
    if wide > 0:
        target = target.where(g.off_axis(dx, dz, wide))
    in_a = seen.select("scene_id", F.col("view_idx").alias("a_view_idx"), "node_id")
    target = target.join(in_a, ["scene_id", "a_view_idx", "node_id"], "left_semi" if variant == "self" else "left_anti")
    pairs = pairs.select("scene_id", "a_view_idx", "b_view_idx")
    if variant == "cross":
        pairs = pairs.join(seen.select("scene_id", F.col("view_idx").alias("b_view_idx"), "node_id"), ["scene_id", "b_view_idx"])
        out = pairs.join(target, ["scene_id", "a_view_idx", "node_id"])
    else:
        out = pairs.join(target, ["scene_id", "a_view_idx"])
    return out.select("scene_id", "node_id", "a_view_idx", "b_view_idx", "dx", "dz").withColumn("answer", g.octant(F.col("dx"), F.col("dz")))


def object_object(views: DataFrame, nodes: DataFrame, seen: DataFrame, gates: dict = PAIR, same: float = 0.3, quota: int | None = None, seed: int = 0) -> DataFrame:
    """Left, right or on one line: object a against b, looking from camera a towards camera b.

    With a quota, only so many pairs of views of a scene meet the pairs of objects.
    """
    a, b = g.camera("a_"), g.camera("b_")
    v = graph.with_node_lists(views, seen, nodes, "tag", "c_x", "c_y")
    p = graph.view_pairs(v).where(graph.diverse(a, b, gates["min_rotation"], gates["min_translation"]))
    fx, fy = F.col("b_pos_x") - F.col("a_pos_x"), F.col("b_pos_y") - F.col("a_pos_y")
    p = p.select("scene_id", "a_view_idx", "b_view_idx", fx.alias("fx"), fy.alias("fy"), g.norm(fx, fy).alias("n"), F.array_union("a_nodes", "b_nodes").alias("nodes")).where("n >= 1e-3")
    p = _some_pairs(p, quota, seed, "a_view_idx", "b_view_idx")
    # Nodes of either view, two at a time, within the row.
    out = p.select("*", F.explode("nodes").alias("m")).select("*", F.explode("nodes").alias("o")).where("m.node_id < o.node_id and m.tag <> o.tag")
    side = ((F.col("m.c_x") - F.col("o.c_x")) * F.col("fy") - (F.col("m.c_y") - F.col("o.c_y")) * F.col("fx")) / F.col("n")
    out = out.withColumn("side", side)
    return out.select("scene_id", "a_view_idx", "b_view_idx", F.col("m.node_id").alias("node_a"), F.col("o.node_id").alias("node_b"), "side", F.when(F.abs(F.round("side", 9)) < same, "Same line").when(F.col("side") > 0, "Right").otherwise("Left").alias("answer"))


def camera_motion(views: DataFrame, still: float = 0.1, still_angle: float = 10.0) -> DataFrame:
    """Static, pure rotation, or main and secondary direction, for all pairs of views."""
    a, b = g.camera("a_"), g.camera("b_")
    p = graph.view_pairs(views)
    move = g.to_camera(a, b.at)
    p = p.select("scene_id", "a_view_idx", "b_view_idx", move.x.alias("x"), move.z.alias("z"), g.norm(*move).alias("distance"), g.rotation_angle(a, b).alias("angle"))
    x, z = F.col("x"), F.col("z")
    ahead = F.abs(z) >= F.abs(x)
    main = F.when(ahead, F.when(z > 0, "Forward").otherwise("Backward")).otherwise(F.when(x > 0, "Right").otherwise("Left"))
    second = F.when(ahead, F.when(x < 0, "left").otherwise("right")).otherwise(F.when(z > 0, "forward").otherwise("backward"))
    small = F.col("distance") < still
    answer = F.when(small & (F.col("angle") < still_angle), "Static").when(small, "Pure rotation").otherwise(F.concat(main, F.lit(" + "), second))
    return p.withColumn("answer", answer)


def _around(views: DataFrame, nodes: DataFrame, seen: DataFrame) -> DataFrame:
    """Pairs of views that see a node, with both cameras' ground vectors from it and their angle."""
    p = graph.view_pairs(graph.with_node_lists(views, seen, nodes, "c_x", "c_y"))
    p = p.select("*", F.explode(F.array_intersect("a_nodes", "b_nodes")).alias("__n")).drop("a_nodes", "b_nodes").select("*", "__n.*").drop("__n")
    vector = {f"{s}{c}": F.col(f"{s}_pos_{c}") - F.col(f"c_{c}") for s in "ab" for c in "xy"}
    p = p.withColumns({f"v{k}": v for k, v in vector.items()})
    ax, ay, bx, by = (F.col(f"v{k}") for k in ("ax", "ay", "bx", "by"))
    p = p.withColumn("far", (g.norm(ax, ay) >= 1e-3) & (g.norm(bx, by) >= 1e-3)).withColumn("cross", ax * by - ay * bx)
    cos = (ax * bx + ay * by) / F.when(F.col("far"), g.norm(ax, ay) * g.norm(bx, by))
    return p.withColumn("angle", F.degrees(F.acos(g.unit_clip(cos))))


def clockwise(views: DataFrame, nodes: DataFrame, seen: DataFrame, least: float = 20.0) -> DataFrame:
    """Whether the way from view a to view b goes clockwise around a node, seen from above."""
    p = _around(views, nodes, seen).where(F.col("far") & (F.round("angle", 9) >= least))
    return p.select("scene_id", "node_id", "a_view_idx", "b_view_idx", "angle", (F.col("cross") < 0).alias("clockwise"))


def view_change(views: DataFrame, nodes: DataFrame, seen: DataFrame, rotated: float = 60.0, moved: float = 0.3, tilted: float = 20.0) -> DataFrame:
    """Rotated, translated, tilted or unchanged: how view b differs from view a around a node."""
    p = _around(views, nodes, seen)
    a, b = g.camera("a_"), g.camera("b_")
    yaw = F.when(F.col("far"), F.col("angle")).otherwise(0.0)
    lateral = g.to_camera(a, b.at).x
    tilt = F.abs(F.degrees(F.asin(g.unit_clip(b.forward.z - a.forward.z))))
    p = p.select("scene_id", "node_id", "a_view_idx", "b_view_idx", "cross", yaw.alias("yaw"), lateral.alias("sideways"), tilt.alias("tilt"))
    answer = (
        F.when(F.round("yaw", 9) >= rotated, F.when(F.col("cross") < 0, "Rotated clockwise").otherwise("Rotated counter-clockwise"))
        .when(F.abs(F.round("sideways", 9)) >= moved, F.when(F.col("sideways") < 0, "Translated left").otherwise("Translated right"))
        .when(F.round("tilt", 9) >= tilted, "Tilted")
        .otherwise("Unchanged")
    )
    return p.withColumn("answer", answer).drop("cross")


def _some_pairs(pairs: DataFrame, quota: int | None, seed: int, *unique: str) -> DataFrame:
    """At most quota pairs a scene, by hash, before a third node joins them; None: all."""
    return pairs if quota is None else sampling.sample(pairs, ["scene_id"], quota, seed, *unique)


def relative_distance(nodes: DataFrame, tolerance: float = 0.3, quota: int | None = None, seed: int = 0) -> DataFrame:
    """Triples of a scene's tags, one node each (the smallest id): is B or C closer to A?

    With a quota, only so many pairs (A, B) of a scene meet a third node: triples then grow with the
    scenes and their tags, not with the cube of the tags.
    """
    n = nodes.where(~F.col("tag").isin(*graph.STRUCTURAL)).groupBy("scene_id", "tag").agg(F.min("node_id").alias("node_id"), *[F.min_by(f"c_{c}", "node_id").alias(f"c_{c}") for c in "xyz"])
    a, b, c = (graph.prefixed(n, f"{s}_", "scene_id") for s in "abc")
    two = _some_pairs(a.join(b, "scene_id").where("a_tag <> b_tag"), quota, seed, "a_node_id", "b_node_id")
    t = two.join(c, "scene_id").where("b_tag < c_tag and a_tag <> c_tag")
    ab, ac = g.distance(g.vec("a_c"), g.vec("b_c")), g.distance(g.vec("a_c"), g.vec("c_c"))
    t = t.select("scene_id", F.col("a_node_id").alias("node_a"), F.col("b_node_id").alias("node_b"), F.col("c_node_id").alias("node_c"), ab.alias("dist_b"), ac.alias("dist_c"))
    return t.withColumn("answer", g.compare(F.col("dist_b"), F.col("dist_c"), tolerance, "B", "C"))


def duplicate_tags(nodes: DataFrame, hidden: tuple[str, ...] = ()) -> DataFrame:
    """Counting: tags of which a scene has several."""
    n = nodes.where(~F.col("tag").isin(*hidden)) if hidden else nodes
    return n.groupBy("scene_id", "tag").agg(F.count("*").alias("n")).where("n > 1")


def volume(prefix: str = "") -> Column:
    return F.abs(F.col(f"{prefix}l_x") * F.col(f"{prefix}l_y") * F.col(f"{prefix}l_z"))


def absolute_size(nodes: DataFrame) -> DataFrame:
    """Largest extent and height of each node, as text in centimetres below a metre, else metres."""
    extent = F.greatest("l_x", "l_y", "l_z")
    return nodes.select("scene_id", "node_id", extent.alias("extent"), F.col("l_z").alias("height"), volume().alias("volume")).withColumns({"extent_text": metric(F.col("extent")), "height_text": metric(F.col("height"))})


def node_pairs(nodes: DataFrame, most: int | None = None) -> DataFrame:
    """Pairs of a scene's nodes of different tags, of its first `most` nodes if given."""
    if most:
        nodes = nodes.withColumn("__n", F.row_number().over(Window.partitionBy("scene_id").orderBy("node_id"))).where(F.col("__n") <= most).drop("__n")
    return graph.prefixed(nodes, "a_", "scene_id").join(graph.prefixed(nodes, "b_", "scene_id"), "scene_id").where("a_node_id < b_node_id and a_tag <> b_tag")


def relative_size(nodes: DataFrame) -> DataFrame:
    """Whether a is larger, and whether it is smaller, than b; neither at equal volume."""
    va, vb = F.round(volume("a_"), 9), F.round(volume("b_"), 9)
    return node_pairs(nodes).select("scene_id", F.col("a_node_id").alias("node_a"), F.col("b_node_id").alias("node_b"), (va > vb).alias("bigger"), (va < vb).alias("smaller"))


def extreme_sizes(nodes: DataFrame) -> DataFrame:
    """Largest and smallest node of each scene; ties to the smaller id."""
    v = F.round(volume(), 9)
    return nodes.groupBy("scene_id").agg(F.max_by("node_id", F.struct(v, -F.col("node_id"))).alias("biggest"), F.min_by("node_id", F.struct(v, F.col("node_id"))).alias("smallest"))


def tops(nodes: DataFrame) -> DataFrame:
    """Nodes with the height of their highest corner."""
    n = nodes.select("*", *g.trig())
    z = [c.z for c in g.corners(g.vec("c"), g.vec("l"), g.box_axes())]
    return n.withColumn("top", F.greatest(*z)).select(*nodes.columns, "top")


def height_comparison(nodes: DataFrame) -> DataFrame:
    """Which of two nodes reaches higher; b if they are level."""
    t = tops(nodes).select("scene_id", "node_id", "tag", F.round("top", 6).alias("top"))
    return node_pairs(t).select("scene_id", F.col("a_node_id").alias("node_a"), F.col("b_node_id").alias("node_b"), "a_top", "b_top", F.when(F.col("a_top") > F.col("b_top"), "A").otherwise("B").alias("answer"))


def box_in_view(views: DataFrame, nodes: DataFrame, seen: DataFrame) -> DataFrame:
    """3-D grounding: every seen box in the camera's frame: centre, size, and angles folded at pi."""
    t = seen.join(views, ["scene_id", "view_idx"]).join(nodes, ["scene_id", "node_id"]).select("*", *g.trig())
    c = g.camera()
    centre = g.to_camera(c, g.vec("c"))
    t = t.select("scene_id", "view_idx", "node_id", *[v.alias(f"x_{k}") for k, v in zip("xyz", centre)], *[F.col(f"l_{k}") for k in "xyz"], *[v.alias(f"axis{i}_{k}") for i, axis in enumerate(_seen_axes(c)) for k, v in zip("xyz", axis)])
    angles = g.angles_of(g.vec("axis0"), g.vec("axis1"), g.vec("axis2"))
    return t.select("scene_id", "view_idx", "node_id", *[F.round(f"x_{k}", 4).alias(f"x_{k}") for k in "xyz"], *[g.folded(a, 4).alias(f"e{i}") for i, a in enumerate(angles)])


def _seen_axes(c: g.Camera) -> list[g.Vec]:
    return [g.Vec(g.dot(a, c.right), g.dot(a, c.down), g.dot(a, c.forward)) for a in g.box_axes()]


def compass_relation(nodes: DataFrame, delta: float = 15.0, quota: int | None = None, seed: int = 0) -> DataFrame:
    """Direction of C from B if A lies to the north of B: triples of a scene's nodes of distinct tags; with
    a quota as in relative_distance."""
    n = nodes.where(~F.col("tag").isin(*graph.STRUCTURAL)).groupBy("scene_id", "tag").agg(F.min("node_id").alias("node_id"), *[F.min_by(f"c_{c}", "node_id").alias(f"c_{c}") for c in "xy"])
    a, b, c = (graph.prefixed(n, f"{s}_", "scene_id") for s in "abc")
    two = _some_pairs(a.join(b, "scene_id").where("a_tag < b_tag"), quota, seed, "a_node_id", "b_node_id")
    t = two.join(c, "scene_id").where("c_tag <> a_tag and c_tag <> b_tag")
    toward = F.degrees(F.atan2(F.col("a_c_x") - F.col("b_c_x"), F.col("a_c_y") - F.col("b_c_y")))
    dx, dy = g.turned(F.col("c_c_x") - F.col("b_c_x"), F.col("c_c_y") - F.col("b_c_y"), toward)
    t = t.select("scene_id", F.col("a_node_id").alias("node_a"), F.col("b_node_id").alias("node_b"), F.col("c_node_id").alias("node_c"), F.round(dx, 9).alias("dx"), F.round(dy, 9).alias("dy"))
    return t.withColumn("answer", g.compass(F.col("dx"), F.col("dy"), delta))


def proximity(pairs: DataFrame, near: float = 0.5, far: float = 2.0) -> DataFrame:
    """pairs with columns distance, extent: "next" or "far" by their ratio; the others go."""
    ratio = F.round(F.col("distance") / F.when(F.col("extent") > 0, F.col("extent")), 9)
    return pairs.withColumn("ratio", F.coalesce(ratio, F.lit(float("inf")))).withColumn("answer", F.when(F.col("ratio") < near, "next").when(F.col("ratio") > far, "far")).where("answer is not null")
