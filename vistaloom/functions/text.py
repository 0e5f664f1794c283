"""Column builders for text: distances, names, prompts, messages, answer types."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What marks a multiple-choice question, and the sign of an image in a prompt.
MCQ = r"\b[A-D]\.\s|\([A-D]\)"
IMAGE = "<image>"
ANSWER = "Answer: "


def metric(metres: Column) -> Column:
    """Text of a distance: centimetres below one metre, else metres, two digits after the point."""
    return F.when(metres < 1, F.format_string("%.2f centimeters", F.round(metres * 100, 2))).otherwise(F.format_string("%.2f meters", F.round(metres, 2)))


def clean_name(name: Column) -> Column:
    """An object's name without numbers, underscores and a trailing run of capitals, in lower case."""
    parts = F.filter(F.split(name, r"[0-9_]+"), lambda p: p != "")
    return F.lower(F.regexp_replace(F.coalesce(F.element_at(F.when(F.size(parts) > 0, parts), -1), F.lit("")), "[A-Z_]+$", ""))


def without_images(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"{IMAGE}\s*", ""))


def output_type(text: Column) -> Column:
    """MCQ or open, by the choices that a question lists."""
    return F.when(text.rlike(MCQ), "MCQ").otherwise("open")


def input_type(task: Column) -> Column:
    return F.when(task.startswith("multiview_") | task.startswith("mmsi_"), "multiview").otherwise("singleview")


def is_rotated(dataset: Column, prefix: str = "arkitscenes") -> Column:
    """Whether a dataset's images are stored turned; of a list of names the first counts."""
    return F.coalesce(F.lower(F.trim(dataset)).startswith(prefix), F.lit(False))


def messages(prompt: Column, images: Column) -> Column:
    """[human, gpt] of a prompt, cut at its first "Answer: "; null if it has none."""
    at = F.instr(prompt, ANSWER)
    human = F.concat(F.repeat(F.lit(IMAGE), images.cast("int")), F.trim(F.substring(prompt, F.lit(1), at - 1)))
    gpt = F.trim(F.substring(prompt, at + len(ANSWER), F.length(prompt)))
    turn = lambda who, value: F.struct(F.lit(who).alias("from"), value.alias("value"))
    return F.when(at > 0, F.array(turn("human", human), turn("gpt", gpt)))


def multi_turn(prompts: Column, images: Column) -> Column:
    """Messages of a list of prompts; prompts without an answer are left out, and the images stand in
    the prompt of place 0 only, also if that one is left out."""
    each = F.transform(prompts, lambda p, i: messages(p, F.when(i == 0, images).otherwise(0)))
    return F.flatten(F.filter(each, lambda m: m.isNotNull()))


def fill(template: Column, values: dict[str, Column]) -> Column:
    """A template with each [KEY] replaced."""
    for key, value in values.items():
        template = F.replace(template, F.lit(f"[{key}]"), value)
    return template


def resolve(path: Column, root: str) -> Column:
    """An absolute path as it is, a relative one under root."""
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def resized(image: Column, suffix: str = "_resized") -> Column:
    """Name of the copy of an image that was brought to the size of its depth map."""
    return F.regexp_replace(image, r"^(.*?)(\.[^./]+)?$", rf"$1{suffix}$2")


def relative(path: Column, root: str) -> Column:
    top = root.rstrip("/") + "/"
    return F.when(path.startswith(top), F.substring(path, len(top) + 1, 1_000_000)).otherwise(path)


#: Colour names that a tag may carry.
COLOURS = ("red", "green", "blue", "yellow", "black", "white", "orange", "purple", "brown", "gray", "pink", "gold", "silver")


def is_colour(tag: Column, local: Column) -> Column:
    """Whether a pair of names (English, Chinese) is a colour."""
    out = local.endswith("色")
    for c in COLOURS:
        out = out | F.lower(tag).contains(c)
    return out


#: The side of a model's input, and what its sides are multiples of.
SIDE, STEP = 518, 14


def model_size(width: Column, height: Column, pad: bool = False) -> Column:
    """struct<width, height, top, left, cut_top, cut_height>: how an image of a size is brought to a model's.

    It is scaled to (width, height), multiples of STEP: SIDE wide, or, if it is to be padded to a square, its
    longer side SIDE. Padding stands at top and left (the rest below and right); without it, what is higher
    than SIDE is cut, cut_height lines from cut_top. Halves are rounded to even.
    """
    scaled = lambda a, b: (F.bround(a * SIDE / b / STEP) * STEP).cast("int")
    side = F.lit(SIDE)
    new_w = F.when(width >= height, side).otherwise(scaled(width, height)) if pad else side
    new_h = F.when(width >= height, scaled(height, width)).otherwise(side) if pad else scaled(height, width)
    half = lambda n: F.floor(F.greatest(side - n, F.lit(0)) / 2).cast("int")
    cut = F.lit(0) if pad else F.floor(F.greatest(new_h - side, F.lit(0)) / 2).cast("int")
    none = F.lit(0)
    return F.struct(new_w.alias("width"), new_h.alias("height"), (half(new_h) if pad else none).alias("top"), (half(new_w) if pad else none).alias("left"), cut.alias("cut_top"), F.least(new_h, side).alias("cut_height"))
