"""What becomes of a detector's and a segmenter's answers: thresholds, duplicates, boxes of masks.

The models are plug-ins (kernels.Model); these operators take the tables that they give.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import annotate, points, tables


def localized(found: DataFrame, masks: DataFrame, least_box: float = 0.3, least_text: float = 0.3, least_mask: float = 0.7, overlap: float = 0.8, least_objects: int = 2) -> DataFrame:
    """Detections that stay: (frame_id, obj_idx, tag, x1, y1, x2, y2).

    found: frame_id, obj_idx, tag, box_score, text_score, mask_score and the 2-D box. masks: frame_id,
    obj_idx, u, v. Low scores go first, then boxes that a larger one of their tag covers, then masks that
    overlap with one of their tag; frames with fewer than least_objects go. Null scores count as low.
    """
    good = found.where((F.col("box_score") >= least_box) & (F.col("text_score") >= least_text) & (F.col("mask_score") >= least_mask))
    good = tables.kept_boxes(good.select("frame_id", "obj_idx", "tag", "x1", "y1", "x2", "y2"), overlap)
    pixels = masks.join(good.select("frame_id", "obj_idx", "tag"), ["frame_id", "obj_idx"])
    good = good.join(annotate.kept_masks(pixels, 0.8, overlap), ["frame_id", "obj_idx"], "left_semi")
    enough = good.groupBy("frame_id").agg(F.count("*").alias("n")).where(F.col("n") >= least_objects)
    return good.join(enough.select("frame_id"), "frame_id", "left_semi")


def refined(masks: DataFrame, scores: DataFrame, least_score: float = 0.6, least_pixels: int = 20) -> DataFrame:
    """(frame_id, obj_idx, x1, y1, x2, y2): objects whose refined mask scores high and has more than
    least_pixels pixels, with the box of the mask. masks: frame_id, obj_idx, u, v; scores: frame_id,
    obj_idx, score."""
    keys = ["frame_id", "obj_idx"]
    good = masks.join(scores.where(F.col("score") >= least_score).select(*keys), keys, "left_semi").select(*keys, "u", "v").distinct()
    large = good.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > least_pixels).select(*keys)
    return points.box_of_mask(good.join(large, keys, "left_semi"), keys)


def with_refined(frames: DataFrame, kept: DataFrame, lists: list[str], key: str = "frame_id") -> DataFrame:
    """frames whose aligned lists keep the places (obj_idx) that are in kept, with bboxes_2d; frames left
    without any go."""
    at = kept.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("obj_idx", "x1", "y1", "x2", "y2"))).alias("__at"))  # objects of one image
    out = frames.join(at, key)
    picked = lambda c: F.transform("__at", lambda x: F.get(F.col(c), x["obj_idx"].cast("int")))
    boxes = F.transform("__at", lambda x: F.array(x["x1"], x["y1"], x["x2"], x["y2"]))
    return out.withColumns({c: picked(c) for c in lists} | {"bboxes_2d": boxes}).drop("__at")
