"""Question wordings by name, as a small table; [X], [Y], ... are filled per question."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: name -> (questions, answers). An answer follows the mark of functions.text.ANSWER. The names are fixed values.
TEMPLATES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "counting.open_ended": (("How many [T] can be seen in this scene?", "Count the [T] here."), ("[A]",)),
    "counting.mcq": (("How many [T] are there? Options: [O]",), ("[A]",)),
    "depth.ordering": (("Order these [T] from the nearest to the farthest: [A].",), ("[X]", "From near to far: [X]")),
    "depth.ordering_mcq": (("Which list puts these [T] in order from near to far: [X]?\n[Y]",), ("[A]",)),
    "depth.choice": (("Of the [T] [A], which is the [B] closest to the camera?",), ("[X]",)),
    "depth.choice_mcq": (("Of the [T] [X], which is the [Y] closest to the camera?\n[Z]",), ("[A]",)),
    "depth.closest": (("Of the [T] [A], which is closest to the camera?",), ("[X]",)),
    "depth.closest_mcq": (("Of the [T] [X], which is closest to the camera?\n[Y]",), ("[A]",)),
    "depth.farthest": (("Of the [T] [A], which is farthest from the camera?",), ("[X]",)),
    "depth.farthest_mcq": (("Of the [T] [X], which is farthest from the camera?\n[Y]",), ("[A]",)),
    "distance.absolute": (("What is the shortest distance between the [A] and the [B]?",), ("[X]",)),
    "distance.absolute_m": (("How many meters lie between the [A] and the [B] where they are nearest?",), ("[X]",)),
    "distance.absolute_cm": (("How many centimeters lie between the [A] and the [B] where they are nearest?",), ("[X]",)),
    "distance.relative_close": (("Which is closer to the [C], the [A] or the [B]?", "Of the [A] and the [B], which one is nearer to the [C]?"), ("[X]",)),
    "distance.relative_far": (("Which is farther from the [C], the [A] or the [B]?",), ("[X]",)),
    "distance.closest": (("Which of these is closest to the [X]: [T]?",), ("[A]",)),
    "distance.farthest": (("Which of these is farthest from the [X]: [T]?",), ("[A]",)),
    "distance.obj_cam": (("In which view is the [T] nearer to the camera?",), ("[A]",)),
    "distance.obj_cam_mcq": (("In which view is the [T] nearer to the camera? Options: [O]",), ("[A]",)),
    "position.height_higher": (("Which reaches higher, the [A] or the [B]?",), ("[X]",)),
    "position.height_lower": (("Which stays lower, the [A] or the [B]?",), ("[X]",)),
    "position.next_far": (("Are the [A] and the [B] next to each other or far apart?",), ("[X]",)),
    "size.absolute.single_view": (("How large is the [A] at its longest?",), ("[X]",)),
    "size.height.single_view": (("How high is the [A]?",), ("[X]",)),
    "size.big.single_view": (("Does the [A] take up more space than the [B]?",), ("[X]",)),
    "size.small.single_view": (("Does the [A] take up less space than the [B]?",), ("[X]",)),
    "size.big.multi_view": (("Over these views, is the [A] bigger than the [B]?",), ("[X]",)),
    "size.small.multi_view": (("Over these views, is the [A] smaller than the [B]?",), ("[X]",)),
    "size.biggest": (("Which of these takes up the most space: [T]?",), ("[X]",)),
    "size.smallest": (("Which of these takes up the least space: [T]?",), ("[X]",)),
    "correspondence.point2point": (("Which [B] point of the second image shows what the [A] point of the first marks?",), ("[T]",)),
    "correspondence.point2point_num": (("Which numbered [B] point of the second image shows what the [A] point of the first marks?",), ("[T]",)),
    "correspondence.object2object": (("Which marked object of the second image is the [A] one of the first?",), ("[T]",)),
    "multiview_position.type1": (("If the [A] is to the [X] of the [B], where is the [C] seen from the [B]?",), ("[T]",)),
    "multiview_position.type1_mcq": (("If the [A] is to the [X] of the [B], where is the [C] seen from the [B]? Options: [O]",), ("[T]",)),
    "multiview_position.type2": (("Take the way from the [B] to the [A] as [X]. Which way from the [B] lies the [C]?",), ("[T]",)),
    "multiview_position.type2_mcq": (("Take the way from the [B] to the [A] as [X]. Which way from the [B] lies the [C]? Options: [O]",), ("[T]",)),
    "grounding_3d.open_ended": (("Give the 3-D box of each [T] in camera coordinates.",), ("[A]",)),
    "grounding_3d.mcq": (("Which is the 3-D box of the [T] in camera coordinates? Options: [O]",), ("[A]",)),
    "grounding_3d.camera_system": (("The camera looks along z, x is to the right, y is down; its field of view is [H] by [V] degrees.",), ("[A]",)),
    "relative_distance.mcq": (("Which is closer to the [X], the [Y] or the [Z]? Options: [O]",), ("[A]",)),
    "clockwise.yes_no": (("Does the camera go clockwise around the [T]?",), ("[A]",)),
    "camera_movement.mcq": (("Which way does the camera mainly move from the first image to the last? Options: [O]",), ("[A]",)),
    "mmsi.camera_camera": (("Seen from the first camera, where does the second one stand? Both see the [T]. Options: [O]",), ("[A]",)),
    "mmsi.camera_object": (("Seen from the first camera, where is the [T]? Options: [O]",), ("[A]",)),
    "mmsi.object_object": (("Looking from the first camera towards the second, is the [X] left or right of the [Y]?",), ("[A]",)),
    "mmsi.camera_motion": (("How did the camera move between the two images?",), ("[A]",)),
    "bev_pose.mcq": (("Which map shows where these images were taken? Options: [O]",), ("[A]",)),
    "manipulation_view.mcq": (("How does the view of the [T] change? Options: [O]",), ("[A]",)),
}


def table(spark: SparkSession) -> DataFrame:
    """(name, kind, idx, text)."""
    rows = [(n, k, i, t) for n, parts in TEMPLATES.items() for k, texts in zip(("question", "answer"), parts) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "name string, kind string, idx int, text string")


def pick(name: str, kind: str, seed: Column) -> Column:
    """One of a template's wordings, by a hashed seed column."""
    texts = TEMPLATES[name][kind == "answer"]
    return F.get(F.array(*map(F.lit, texts)), F.pmod(F.xxhash64(seed), F.lit(len(texts))).cast("int"))


def prompt(name: str, seed: Column, values: dict[str, Column]) -> Column:
    """Question and answer in one text."""
    from .text import ANSWER, fill

    return fill(F.concat(pick(name, "question", seed), F.lit(f" {ANSWER}"), pick(name, "answer", seed)), values)


def any_prompt(name: Column, names: list[str], seed: Column, values: dict[str, Column]) -> Column:
    """prompt() of the template that a column names, one of names."""
    out = F.lit(None).cast("string")
    for n in names:
        out = F.when(name == n, prompt(n, seed, values)).otherwise(out)
    return out
