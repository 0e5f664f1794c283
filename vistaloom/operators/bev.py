"""Bird's-eye maps: bounds, cells, facings, perturbed copies."""

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g

GRID, PADDING, EXTENT = 10, 0.1, 1.0


def entities(views: DataFrame, nodes: DataFrame) -> DataFrame:
    """Cameras and objects of scenes as (scene_id, kind, entity_id, x, y, half_x, half_y, yaw)."""
    zero = F.lit(0.0)
    cams = views.select("scene_id", F.lit("camera").alias("kind"), F.col("view_idx").alias("entity_id"), F.col("pos_x").alias("x"), F.col("pos_y").alias("y"), zero.alias("half_x"), zero.alias("half_y"), F.degrees(F.atan2("fwd_y", "fwd_x")).alias("yaw"))
    objs = nodes.select("scene_id", F.lit("object").alias("kind"), F.col("node_id").alias("entity_id"), F.col("c_x").alias("x"), F.col("c_y").alias("y"), (F.col("l_x") / 2).alias("half_x"), (F.col("l_y") / 2).alias("half_y"), F.degrees("e2").alias("yaw"))
    return cams.unionByName(objs)


def bounds(e: DataFrame, padding: float = PADDING, extent: float = EXTENT) -> DataFrame:
    """(scene_id, xmin, ymin, xmax, ymax): a metre at least where all is at one place, then padding."""
    b = e.groupBy("scene_id").agg(*[f(F.col(c) + s * F.col(f"half_{c}")).alias(f"{c}{n}") for c in "xy" for n, f, s in (("min", F.min, -1), ("max", F.max, 1))])
    out = ["scene_id"]
    for c in "xy":
        lo, hi = F.col(f"{c}min"), F.col(f"{c}max")
        thin = hi - lo < 1e-6
        lo, hi = F.when(thin, lo - extent / 2).otherwise(lo), F.when(thin, hi + extent / 2).otherwise(hi)
        out += [(lo - (hi - lo) * padding).alias(f"{c}min"), (hi + (hi - lo) * padding).alias(f"{c}max")]
    return b.select(*out)


def cell(v: Column, lo: Column, hi: Column, grid: int = GRID) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(grid - 1), F.round((v - lo) / (hi - lo) * grid, 9).cast("int")))


def placed(e: DataFrame, b: DataFrame, grid: int = GRID) -> DataFrame:
    """Entities with their row, column and facing."""
    p = e.join(b, "scene_id")
    p = p.withColumn("row", cell(F.col("y"), F.col("ymin"), F.col("ymax"), grid)).withColumn("col", cell(F.col("x"), F.col("xmin"), F.col("xmax"), grid))
    return p.withColumn("facing", g.sector(F.round("yaw", 9), g.FACINGS)).drop("xmin", "xmax", "ymin", "ymax")


def occupancy(p: DataFrame) -> DataFrame:
    return p.groupBy("scene_id", "row", "col").agg(F.count("*").alias("n"))


def grids(p: DataFrame, grid: int = GRID) -> DataFrame:
    """The map itself, a row a scene: cells as list of rows, and cameras and objects as structs."""
    cells = occupancy(p).groupBy("scene_id").agg(F.map_from_entries(F.collect_list(F.struct((F.col("row") * grid + F.col("col")).alias("k"), "n"))).alias("m"))
    full = F.transform(F.sequence(F.lit(0), F.lit(grid - 1)), lambda r: F.transform(F.sequence(F.lit(0), F.lit(grid - 1)), lambda c: F.coalesce(F.try_element_at("m", r * grid + c), F.lit(0)).cast("int")))
    # Cameras are called by the number of their image; objects by their tag, if there is one.
    nth = F.row_number().over(Window.partitionBy("scene_id", "kind").orderBy("entity_id"))
    p = p.withColumn("name", F.when(F.col("kind") == "camera", F.concat(F.lit("Image "), nth)).otherwise(F.col("tag") if "tag" in p.columns else F.col("entity_id").cast("string")))
    one = F.struct("entity_id", "name", F.array("col", "row").alias("position"), F.when((F.col("kind") == "camera") | (F.col("yaw") != 0), F.col("facing")).alias("facing"))
    sides = p.groupBy("scene_id").agg(*[F.sort_array(F.collect_list(F.when(F.col("kind") == k, one))).alias(f"{k}s") for k in ("camera", "object")])
    return cells.select("scene_id", full.alias("cells")).join(sides, "scene_id")


def attached(questions: DataFrame, placed_: DataFrame, enable: bool = True, views: str | None = None) -> DataFrame:
    """questions with `cognitive_map`, their scene's map as JSON (null if maps are not enabled, or there is none).

    views names a list column of view numbers: the map then shows these cameras only.
    """
    if not enable:
        return questions.withColumn("cognitive_map", F.lit(None).cast("string"))
    out = questions.join(grids(placed_), "scene_id", "left")
    cameras = F.col("cameras") if views is None else F.filter("cameras", lambda c: F.array_contains(F.col(views), c["entity_id"]))
    whole = F.to_json(F.struct("cells", cameras.alias("cameras"), "objects"))
    return out.withColumn("cognitive_map", F.when(F.col("cells").isNotNull(), whole)).drop("cells", "cameras", "objects")


#: Ways to make a wrong map.
PERTURBATIONS = ("mirror_x", "mirror_y", "rotate_180", "shuffle")


def perturbed(e: DataFrame, b: DataFrame, op: str, seed: int = 0) -> DataFrame:
    """Entities whose cameras are moved, one of PERTURBATIONS; objects stay, as what the eye holds on to.

    Mirrors and the half turn are about the middle of the bounds and turn the cameras too. "shuffle"
    gives each camera the place of the next in hash order (yaws stay), so two or more cameras at different
    places never all keep theirs.
    """
    camera = F.col("kind") == "camera"
    if op == "shuffle":
        cams = e.where(camera)
        w = Window.partitionBy("scene_id").orderBy(F.xxhash64(F.lit(seed), "scene_id", "entity_id"), "entity_id")
        all_ = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        moved = cams.withColumns({f"__{c}": F.coalesce(F.lead(c).over(w), F.first(c).over(all_)) for c in "xy"})
        moved = moved.withColumn("x", F.col("__x")).withColumn("y", F.col("__y")).select(*e.columns)
        return moved.unionByName(e.where(~camera))
    p = e.join(b, "scene_id")
    for c in {"mirror_x": "x", "mirror_y": "y", "rotate_180": "xy"}[op]:
        p = p.withColumn(c, F.when(camera, F.col(f"{c}min") + F.col(f"{c}max") - F.col(c)).otherwise(F.col(c)))
    yaw = {"mirror_x": 180 - F.col("yaw"), "mirror_y": -F.col("yaw"), "rotate_180": F.col("yaw") + 180}[op]
    return p.withColumn("yaw", F.when(camera, yaw).otherwise(F.col("yaw"))).select(*e.columns)


def pose_options(views: DataFrame, nodes: DataFrame, seed: int = 0) -> DataFrame:
    """(scene_id, option, op, right, map): four maps A to D of each scene's chosen views: the true one
    ("true") and three of PERTURBATIONS, picked and ordered by hash. map: cameras and objects with their
    places, a row an entity. What draws them is a plug-in (kernels.Model)."""
    e = entities(views, nodes)
    b = bounds(e)
    maps = [e.withColumn("op", F.lit("true"))] + [perturbed(e, b, op, seed).withColumn("op", F.lit(op)) for op in PERTURBATIONS]
    whole = functools.reduce(DataFrame.unionByName, maps)
    at = F.struct("kind", "entity_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), F.round(F.pmod(F.col("yaw"), F.lit(360.0)), 6).alias("yaw"))
    whole = whole.groupBy("scene_id", "op").agg(F.sort_array(F.collect_list(at)).alias("map"))  # entities of one scene
    # Three of the four wrong ones, then all four in hash order.
    wrong = F.col("op") != "true"
    one = Window.partitionBy("scene_id").orderBy(wrong, F.xxhash64(F.lit(seed), "scene_id", "op"))
    four = whole.withColumn("__n", F.row_number().over(one)).where("__n <= 4")
    place = Window.partitionBy("scene_id").orderBy(F.xxhash64(F.lit(seed + 1), "scene_id", "op"))
    option = F.element_at(F.array(*map(F.lit, "ABCD")), F.row_number().over(place))
    return four.select("scene_id", option.alias("option"), "op", (~wrong).alias("right"), "map")
