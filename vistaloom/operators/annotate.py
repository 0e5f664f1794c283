"""From answers to question records: options, prompts, messages, and the alignment of question lists."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import templates, text
from . import sampling
from .points import range_join

#: Mark colours, in the order they are given out.
COLOURS = ("red", "blue", "green", "pink", "yellow", "orange", "purple", "brown")


def questions(df: DataFrame, template: str, values: dict[str, Column], seed: Column, images: int = 1, quota: int | None = None, scene: str = "scene_id", options: Column | None = None) -> DataFrame:
    """df with columns prompt and messages; at most quota rows a scene, in hash order of the seed.

    options: a list to letter as [O]; the value "A" of `values` is then the right one and becomes its letter.
    """
    if quota is not None:
        w = Window.partitionBy(scene).orderBy(F.xxhash64(seed), seed)
        df = df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= quota).drop("__n")
    if options is not None:
        lettered = F.transform(options, lambda o, i: F.concat(F.element_at(F.split(F.lit("A,B,C,D,E,F,G,H"), ","), i + 1), F.lit(". "), o))
        values = values | {"O": F.array_join(lettered, " "), "A": sampling.letter(options, values["A"])}
    out = df.withColumn("prompt", templates.prompt(template, seed, values))
    return out.withColumn("messages", text.messages(F.col("prompt"), F.lit(images)))


def aligned(df: DataFrame, prompts: str = "messages", images: str = "QA_images", tags: str = "question_tags") -> DataFrame:
    """One row per question of a record: chats of fewer than two turns go; flat lists are cut in pairs.

    Images are padded with their last one, and cut, to the number of questions; short tag lists end in nulls.
    """
    flat = not df.schema[prompts].dataType.simpleString().startswith("array<array")
    chats = F.col(prompts)
    if flat:
        n = F.floor(F.size(prompts) / 2).cast("int")
        chats = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(F.col(prompts), 2 * i + 1, 2))).otherwise(F.slice(F.array(F.col(prompts)), 1, 0))
    rest = [c for c in df.columns if c not in (prompts, images, tags)]
    out = df.select(*rest, *[c for c in (images, tags) if c in df.columns], F.posexplode(chats).alias("qa_idx", prompts))
    if images in df.columns:
        out = out.withColumn(images, F.coalesce(F.get(images, F.col("qa_idx")), F.element_at(F.when(F.size(images) > 0, F.col(images)), -1)))
    if tags in df.columns:
        out = out.withColumn(tags, F.get(tags, F.col("qa_idx")))
    return out.where(F.size(prompts) >= 2)


def marks(nodes: DataFrame, group: list[str], order: str, seed: int = 0, share: float = 0.8) -> DataFrame:
    """Colour and wording of each object of a question: "tag-(colour)" if the question is marked, else
    the bare tag. There are eight colours: a ninth object fails the job."""
    n = nodes.withColumn("__i", F.row_number().over(Window.partitionBy(*group).orderBy(order)))
    colour = F.when(F.col("__i") > len(COLOURS), F.raise_error(F.lit("more objects than colours"))).otherwise(F.element_at(F.array(*map(F.lit, COLOURS)), F.least(F.col("__i"), F.lit(len(COLOURS)))))
    n = n.withColumn("colour", colour.cast("string")).withColumn("marked", sampling.fraction(seed, *group) < share)
    return n.withColumn("wording", F.when(F.col("marked"), F.concat(F.col("tag"), F.lit("-("), F.col("colour"), F.lit(")"))).otherwise(F.col("tag"))).drop("__i")


def kept_masks(pixels: DataFrame, first: float = 0.8, second: float = 0.8) -> DataFrame:
    """(frame_id, obj_idx) of masks that stay: of two of one tag whose overlap is over `first` of the
    earlier or `second` of the later, the smaller goes (the later of equals). pixels: frame_id, obj_idx, tag, u, v."""
    p = pixels.select("frame_id", "obj_idx", "tag", "u", "v").distinct()
    sizes = p.groupBy("frame_id", "obj_idx", "tag").agg(F.count("*").alias("n"))
    other = p.select("frame_id", "tag", "u", "v", F.col("obj_idx").alias("other"))
    common = p.join(other, ["frame_id", "tag", "u", "v"]).where("obj_idx < other").groupBy("frame_id", "obj_idx", "other").agg(F.count("*").alias("both"))
    s = sizes.select("frame_id", "obj_idx", F.col("n").alias("n_i"))
    common = common.join(s, ["frame_id", "obj_idx"]).join(s.select("frame_id", F.col("obj_idx").alias("other"), F.col("n_i").alias("n_j")), ["frame_id", "other"])
    clash = common.where((F.col("both") / F.col("n_i") > first) | (F.col("both") / F.col("n_j") > second))
    lost = clash.select("frame_id", F.when(F.col("n_i") < F.col("n_j"), F.col("obj_idx")).otherwise(F.col("other")).alias("obj_idx")).distinct()
    return sizes.select("frame_id", "obj_idx").join(lost, ["frame_id", "obj_idx"], "left_anti")


def distinct_depths(pixels: DataFrame, keys: list[str], n: int = 5, gap: float = 0.05, seed: int = 0) -> DataFrame:
    """Up to n pixels of each key, greedily in hash order, whose depths differ by more than gap.

    The fold runs over the least-hash pixel of each depth step, so its list is bounded by depth range / gap.
    """
    step = F.floor(F.col("d") / gap)
    one = pixels.where("d > 0").groupBy(*keys, step.alias("__s")).agg(F.min_by(F.struct("d", "u", "v"), F.xxhash64(F.lit(seed), "u", "v", "d")).alias("x"))
    item = F.struct(F.xxhash64(F.lit(seed), "__s", F.col("x.u"), F.col("x.v")).alias("k"), F.col("x.d").alias("d"), F.col("x.u").alias("u"), F.col("x.v").alias("v"))
    lists = one.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("all"))
    chosen = F.aggregate("all", F.slice("all", 1, 0), lambda acc, x: F.when((F.size(acc) < n) & F.forall(acc, lambda y: F.abs(y["d"] - x["d"]) > gap), F.concat(acc, F.array(x))).otherwise(acc))
    return lists.select(*keys, F.posexplode(chosen).alias("place", "x")).select(*keys, "place", "x.u", "x.v", "x.d")


def exposure(pixels: DataFrame, frame: str = "frame_id", value: str = "brightness", share: float = 0.9, target: float = 0.8, gamma: float = 1 / 2.2) -> DataFrame:
    """Tone mapping: each frame's scale puts its 90th percentile at target; null brightness goes."""
    scale = pixels.groupBy(frame).agg(F.percentile(value, F.lit(share)).alias("__p"))
    scale = scale.select(frame, F.when(F.col("__p") > 1e-4, F.pow(F.lit(target), F.lit(1 / gamma)) / F.col("__p")).otherwise(0.0).alias("scale"))
    return pixels.join(scale, frame).withColumn("mapped", F.least(F.lit(1.0), F.pow(F.greatest(F.lit(0.0), F.col("scale") * F.col(value)), F.lit(gamma))))


def annotated_box(centroid: Column, lengths: Column, axes: Column) -> Column:
    """array<double>[9] of an annotated box: centre, lengths, and the angles of the axes (9 numbers, an axis after the other)."""
    at = lambda i: F.get(axes, F.lit(i))
    angles = g.angles_of(*[g.Vec(at(3 * k), at(3 * k + 1), at(3 * k + 2)) for k in range(3)])
    return F.concat(centroid, lengths, F.array(*angles))


def correspondences(a: DataFrame, b: DataFrame, keys: list[str], radius: float = 0.003, margin: int = 10, size: tuple[int, int] = (64, 48), least: int = 10) -> DataFrame:
    """Pixels of a (u, v, p_*) with their nearest point of b within a radius, both `margin` pixels from
    the image edge; keys with fewer than `least` of them go. Points are in world coordinates."""
    inside = lambda u, v: F.col(u).between(margin, size[0] - 1 - margin) & F.col(v).between(margin, size[1] - 1 - margin)
    left, right = a.where(inside("u", "v")), b.where(inside("u", "v")).withColumnsRenamed({"u": "u2", "v": "v2"})
    near = range_join(left, right, radius, keys)
    best = near.groupBy(*keys, "u", "v").agg(F.min_by(F.struct("u2", "v2"), F.struct("distance", "u2", "v2")).alias("m"), F.min("distance").alias("distance"))
    enough = best.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") >= least).select(*keys)
    return best.join(enough, keys, "left_semi").select(*keys, "u", "v", "m.u2", "m.v2", "distance")
