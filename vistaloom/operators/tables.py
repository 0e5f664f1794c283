"""Reshaping and checking scene records: flatten, group, tag filters, duplicates, funnels, validation."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import checkpointed
from .graph import require_columns


def flatten(df: DataFrame, anchor: str, columns: list[str], order: str | None = None) -> DataFrame:
    """One row per element of the anchor list; the other columns named go along element by element.

    Every other column repeats. A row whose anchor is not a list passes as it is. ValueError if a
    column is missing; lists of unequal length fail the job. Null and empty lists give no rows.
    `order` names a column for the element's place.
    """
    require_columns(df, anchor, *columns)
    lists = [anchor, *[c for c in columns if c != anchor]]
    if not isinstance(df.schema[anchor].dataType, T.ArrayType):
        return df
    not_lists = [c for c in lists if not isinstance(df.schema[c].dataType, T.ArrayType)]
    if not_lists:
        raise ValueError(f"not lists: {', '.join(not_lists)}")
    for c in lists[1:]:
        fits = F.size(c) == F.size(anchor)
        df = df.withColumn(c, F.when(F.coalesce(fits, F.lit(False)), F.col(c)).otherwise(F.raise_error(F.lit(f"{c} and {anchor} are of unequal length")).cast(df.schema[c].dataType)))
    rest = [c for c in df.columns if c not in lists]
    out = df.select(*rest, F.posexplode(F.arrays_zip(*lists)).alias("__pos", "__x"))
    named = {c: F.col("__x").getField(c) for c in lists}
    return out.select(*[named.get(c, F.col(c)).alias(c) for c in df.columns], *([F.col("__pos").alias(order)] if order else []))


def group(df: DataFrame, key: str, lists: list[str], order: str) -> DataFrame:
    """One row per key: columns of `lists` become lists in row order, nulls kept; others take the
    first row's value. ValueError for missing columns; a null key fails the job."""
    require_columns(df, key, order, *lists)
    df = df.withColumn(key, F.coalesce(F.col(key), F.raise_error(F.lit(f"null {key}")).cast(df.schema[key].dataType)))
    rest = [c for c in df.columns if c not in (key, order, *lists)]
    rows = F.sort_array(F.collect_list(F.struct(order, *[F.struct(c).alias(c) for c in lists])))
    out = df.groupBy(key).agg(rows.alias("__rows"), *([F.min_by(F.struct(*rest), order).alias("__first")] if rest else []))
    pick = lambda c: F.transform("__rows", lambda r: r[c][c])
    return out.select(key, *[F.col("__first").getField(c).alias(c) for c in rest], *[pick(c).alias(c) for c in lists])


def merge_scenes(frames: DataFrame, order: str = "view_idx", scalars: tuple[str, ...] = ("dataset",)) -> DataFrame:
    """Per-image rows to per-scene rows: scalars keep the first value, the rest become lists, and
    num_images counts them."""
    require_columns(frames, "scene_id", order)
    lists = [c for c in frames.columns if c not in ("scene_id", order, *scalars)]
    out = group(frames, "scene_id", lists, order)
    return out.withColumn("num_images", F.size(lists[0]) if lists else F.lit(0))


def flatten_qa(df: DataFrame, columns: tuple[str, ...] = ("messages", "QA_images", "question_tags", "question_types", "cognitive_maps"), keep: tuple[str, ...] = ("image",)) -> DataFrame:
    """One row per question: the question-aligned lists that are there, element by element.

    An empty or null list counts as absent and gives nulls; rows with none of them go; lists of
    unequal length fail the job.
    """
    there = [c for c in columns if c in df.columns]
    if not there:
        raise ValueError("no question columns")
    size = {c: F.when(F.size(c) > 0, F.size(c)) for c in there}
    n = F.coalesce(*size.values())
    bad = F.exists(F.array(*size.values()), lambda s: s.isNotNull() & (s != n))
    n = F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.lit("question lists of unequal length")).cast("int")).otherwise(n)
    out = df.select(*[c for c in keep if c in df.columns], *there, n.alias("__n")).where("__n > 0")
    out = out.withColumn("qa_idx", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    return out.select(*[c for c in keep if c in df.columns], "qa_idx", *[F.get(F.when(F.size(c) > 0, F.col(c)), F.col("qa_idx")).alias(c) for c in there])


def aligned_filter(df: DataFrame, anchor: str, keep, columns: list[str]) -> DataFrame:
    """Keeps the places of aligned lists where keep(anchor element) holds; rows left empty go."""
    at = F.filter(F.transform(anchor, lambda x, i: F.when(keep(x), i).otherwise(F.lit(-1))), lambda i: i >= 0)
    out = df.withColumn("__at", at).where(F.size("__at") > 0)
    at_places = lambda c: F.transform("__at", lambda i: F.get(F.col(c), i))
    return out.withColumns({c: at_places(c) for c in dict.fromkeys([anchor, *columns])}).drop("__at")


def without_tags(df: DataFrame, tags: tuple[str, ...], columns: list[str], anchor: str = "obj_tags") -> DataFrame:
    return aligned_filter(df, anchor, lambda x: ~F.coalesce(x.isin(*tags), F.lit(False)), columns)


def by_flags(df: DataFrame, flags: str, columns: list[str] | None = None) -> DataFrame:
    """Filters every list that is as long as the flags (or those named) by them."""
    lists = columns or [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType) and f.name != flags]
    for c in lists:
        df = df.withColumn(c, F.when(F.size(c) == F.size(flags), F.filter(c, lambda _, i: F.get(F.col(flags), i))).otherwise(F.col(c)))
    return df


def kept_boxes(boxes: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Boxes that no larger box of the same tag in their frame covers for over `threshold` of the
    smaller one's area; of equal ones the later goes. A box that goes still removes others."""
    require_columns(boxes, "frame_id", "obj_idx", "tag", "x1", "y1", "x2", "y2")
    b = boxes.withColumn("area", (F.greatest(F.lit(0), F.col("x2") - F.col("x1")) * F.greatest(F.lit(0), F.col("y2") - F.col("y1"))).cast("double"))
    cols = ["obj_idx", "x1", "y1", "x2", "y2", "area"]
    i = b.select("frame_id", "tag", *[F.col(c).alias(f"i_{c}") for c in cols])
    j = b.select("frame_id", "tag", *[F.col(c).alias(f"j_{c}") for c in cols])
    p = i.join(j, ["frame_id", "tag"]).where("i_obj_idx < j_obj_idx")
    w = F.least("i_x2", "j_x2") - F.greatest("i_x1", "j_x1")
    h = F.least("i_y2", "j_y2") - F.greatest("i_y1", "j_y1")
    least = F.least("i_area", "j_area")
    p = p.where((w > 0) & (h > 0) & (least > 0)).where(w * h / least > threshold)
    lost = p.select("frame_id", F.when(F.col("i_area") < F.col("j_area"), F.col("i_obj_idx")).otherwise(F.col("j_obj_idx")).alias("obj_idx")).distinct()
    return boxes.join(lost, ["frame_id", "obj_idx"], "left_anti")


def tag_histogram(tags: DataFrame, most: int = 15, column: str = "tag") -> DataFrame:
    """The most frequent tags, ties by name. column holds a tag, a list of tags or a list of such lists."""
    kind, tag = tags.schema[column].dataType, F.col(column)
    while isinstance(kind, T.ArrayType):
        tags = tags.select(F.explode(tag).alias(column))
        kind, tag = kind.elementType, F.col(column)
    return tags.groupBy(tag.alias("tag")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "tag").limit(most)


def funnel(counts: DataFrame, warn: float = 0.02, strong: float = 0.005) -> DataFrame:
    """counts: (part, stage_no, stage, n_rows). Adds the rows of the stage before and the share that
    survived, with a warning level; a first stage stands beside itself. The window sees a row a stage and part."""
    w = Window.partitionBy("part").orderBy("stage_no")
    out = counts.withColumn("prev_rows", F.coalesce(F.lag("n_rows").over(w), F.col("n_rows")))
    out = out.withColumn("survival", F.round(F.when(F.col("prev_rows") > 0, F.col("n_rows") / F.col("prev_rows")).otherwise(0.0), 6))
    return out.withColumn("level", F.when(F.col("survival") < strong, "strong").when(F.col("survival") < warn, "warn").otherwise("ok"))


def leaks(tags: DataFrame, bad: tuple[str, ...] = ("wall", "floor", "ceiling", "object")) -> DataFrame:
    """Tags that a filter should have taken out, with counts."""
    low = F.lower("tag")
    return tags.where(low.isin(*bad)).groupBy(low.alias("tag")).agg(F.count("*").alias("n"))


def invalid_poses(views: DataFrame, prefix: tuple[str, str, str] = ("right", "down", "fwd")) -> DataFrame:
    """Views with the determinant of their rotation and whether it lies in [0.9, 1.1]."""
    (a, b, c), (d, e, f), (g, h, i) = ([F.col(f"{n}_{k}") for n in prefix] for k in "xyz")
    det = a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)
    return views.withColumn("det", F.round(det, 6)).withColumn("valid", F.col("det").between(0.9, 1.1))


def invalid_records(records: DataFrame, required: tuple[str, ...], scales: tuple[int, ...] = (1000, 4000)) -> DataFrame:
    """(id, problem): null required fields, and depth scales other than the usual."""
    tests = {f"missing {c}": F.col(c).isNull() for c in required}
    if "depth_scale" in records.columns:
        tests["depth_scale"] = ~F.col("depth_scale").isin(*scales)
    found = F.filter(F.array(*[F.when(t, F.lit(n)) for n, t in tests.items()]), lambda x: x.isNotNull())
    return records.select("id", F.explode(found).alias("problem"))


def counts_agree(scenes: DataFrame, frames: DataFrame) -> DataFrame:
    """One row: images that scenes claim, frames there are, and whether they agree."""
    a = scenes.agg(F.coalesce(F.sum("num_images"), F.lit(0)).cast("long").alias("claimed"))
    b = frames.agg(F.count("*").alias("frames"))
    return a.crossJoin(b).withColumn("agree", F.col("claimed") == F.col("frames"))  # one row each


def not_done(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Resume: work whose key the ledger does not have."""
    return work.join(done.select(key).distinct(), key, "left_anti")


def failures(log: DataFrame, by: str = "status", order: str = "id", most: int = 10) -> tuple[DataFrame, DataFrame]:
    """Counts per status, and the first few of each."""
    first = log.withColumn("__n", F.row_number().over(Window.partitionBy(by).orderBy(order))).where(F.col("__n") <= most).drop("__n")
    return log.groupBy(by).agg(F.count("*").alias("n")), first


def numbered(df: DataFrame, *order: str, name: str = "flat_idx", ranges: int | None = None) -> DataFrame:
    """Adds a row's place (from 0) in the order given, unique and gapless, without one task for all.

    Rows are range-partitioned and sorted; a range's base is the prefix sum of the ranges before. The
    ranges are checkpointed first: a range partitioning samples its bounds, so the branch that counts
    and the branch that numbers must read the same ranges, and a repeated task must too. Rows of equal
    order stand in any order, but in one.
    """
    spark, names = df.sparkSession, ["__p", "__m", "__b", "__c"]
    low = {c.lower() for c in df.columns}
    p, m, b, c = (next(x for x in (n + "_" * i for i in range(99)) if x not in low) for n in names)
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = checkpointed(df.repartitionByRange(n, *order).sortWithinPartitions(*order))
    parts = parts.withColumn(p, F.spark_partition_id()).withColumn(m, F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)))
    sizes = parts.groupBy(p).agg(F.count("*").alias(c))
    base = sizes.select(p, F.coalesce(F.sum(c).over(Window.orderBy(p).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(b))  # a row a range
    return parts.join(F.broadcast(base), p).withColumn(name, F.col(b) + F.col(m)).drop(p, m, b)  # a row a range


def page(df: DataFrame, number: int, size: int, *order: str) -> DataFrame:
    """The number-th page (from 1): a sorted top-k and an offset, no full numbering."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def union_tasks(tasks: dict[str, DataFrame]) -> DataFrame:
    """All tasks' questions with the task's name; columns that a task lacks are null."""
    out = None
    for name, df in tasks.items():
        df = df.withColumn("task", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no tasks")
    return out


def complete_frames(listings: dict[str, DataFrame], first: str, key: tuple[str, ...] = ("scene_id", "frame_name")) -> DataFrame:
    """Frames of one listing that all others have too: semi joins on the listings, no file checks."""
    out = listings[first]
    for name, df in listings.items():
        if name != first:
            out = out.join(df.select(*key).distinct(), list(key), "left_semi")
    return out


def with_lookup(df: DataFrame, lookup: DataFrame, key: str, value: str, default: str = "Unknown") -> DataFrame:
    """Left lookup; the smallest value of a repeated key serves, absent keys get the default."""
    one = lookup.groupBy(key).agg(F.min(value).alias(value))
    return df.join(one, key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def skip_reasons(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """How many rows each test stops, tests in order; "ok" for the rest."""
    reason = F.lit("ok")
    for name, test in reversed(tests.items()):
        reason = F.when(test, name).otherwise(reason)
    return df.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def first_seen(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Ordered dedup: of rows of equal keys the first in order stays, whole."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("__x")).select(*[F.col("__x").getField(c).alias(c) if c in rest else F.col(c) for c in df.columns])


def limited(df: DataFrame, groups: str, most_groups: int | None = None, most_rows: int | None = None, order: tuple[str, ...] = ()) -> DataFrame:
    """Smoke runs: rows of the first most_groups groups, then the first most_rows rows, both in order.

    The bounded list of groups joins by broadcast; without limits df is as it was.
    """
    if most_groups is not None:
        some = df.select(groups).distinct().orderBy(groups).limit(most_groups)
        df = df.join(F.broadcast(some), groups, "left_semi")
    return df if most_rows is None else df.orderBy(groups, *order).limit(most_rows)


def missing_paths(records: DataFrame, listing: DataFrame, columns: tuple[str, ...], most: int | None = 100, key: str = "id", path: str = "path") -> DataFrame:
    """(key, field, path) of paths that a listing does not have, for at most `most` records in the order
    of a hash of their key (None: all). An anti join with the listing; no file is touched."""
    if most is not None:
        records = records.orderBy(F.xxhash64(key), key).limit(most)
    named = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias(path)) for c in columns])
    each = records.select(key, F.explode(named).alias("x")).select(key, "x.field", f"x.{path}").where(F.col(path).isNotNull())
    return each.join(listing.select(path).distinct(), path, "left_anti").select(key, "field", path)


def task_checks(records: DataFrame, tags: str = "obj_tags", depth: str = "depth_map", masks: str = "masks") -> DataFrame:
    """Which tasks a record can serve: `counting` needs more than one tag, `depth` at least three tags, a
    depth map and masks. Columns that are not there count as null."""
    n = F.coalesce(F.size(tags), F.lit(0)) if tags in records.columns else F.lit(0)
    there = lambda c: F.col(c).isNotNull() if c in records.columns else F.lit(False)
    return records.withColumns({"counting": n > 1, "depth": (n >= 3) & there(depth) & there(masks)})


#: Fields that a scene record needs, as lists of one length.
SCENE_LISTS = ("image", "pose", "intrinsic", "obj_tags", "masks", "depth_map", "bboxes_3d_world_coords")


def single_checked(df: DataFrame) -> DataFrame:
    """Records of one image that can be annotated: an image and a tag at least. Without these columns: none."""
    if not {"image", "obj_tags"} <= set(df.columns):
        return df.where(F.lit(False))
    return df.where(F.col("image").isNotNull() & (F.size("obj_tags") > 0))


def multi_checked(df: DataFrame, lists: list[str] = list(SCENE_LISTS)) -> DataFrame:
    """Scene records whose lists are all there, of one length and not empty. Without a column: none."""
    if not set(lists) <= set(df.columns):
        return df.where(F.lit(False))
    n = F.size(lists[0])
    test = n > 0
    for c in lists[1:]:
        test = test & (F.size(c) == n)
    return df.where(F.coalesce(test, F.lit(False)))


#: Labels that say nothing of an object, and the word for an object without a name.
BLANK = ("blinds", "door", "otherfurniture", "otherprop", "otherstructure", "wall")
UNKNOWN = "Unknown"


def gathered_tag(label: Column, name: Column) -> Column:
    """An object's tag: its label, unless that is null or blank; then its name; else UNKNOWN."""
    said = F.when(~label.isin(*BLANK, UNKNOWN), label)
    return F.coalesce(said, F.when(name != UNKNOWN, name), F.lit(UNKNOWN))
