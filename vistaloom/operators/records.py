"""Question records of tasks that need more than an answer column: depth lists, chains of views, positions,
correspondences, maps. Each gives rows with prompt and messages; all choices are by hash and repeatable.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import templates, text
from . import bev, graph, kernels, points, sampling, tasks

#: Words for places in an order.
ORDINALS = ("first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth")
LETTERS = "ABCD"


def _messages(df: DataFrame, prompt: Column, images: int) -> DataFrame:
    return df.withColumn("prompt", prompt).withColumn("messages", text.messages(F.col("prompt"), F.lit(images)))


def _lettered(options: Column, between: str = "\n") -> Column:
    return F.array_join(F.transform(options, lambda o, i: F.concat(F.substring(F.lit(LETTERS), i + 1, F.lit(1)), F.lit(":"), o)), between)


def _some(items: Column, n: int, *seed: Column) -> Column:
    """n elements of a list in hash order."""
    pairs = F.transform(items, lambda o, i: F.struct(F.xxhash64(*seed, i).alias("k"), i.alias("i"), o.alias("o")))
    return F.transform(F.slice(F.array_sort(pairs), 1, n), lambda p: p["o"])


def wrong_orders(items: Column) -> Column:
    """Four other orders of a list of three or more: turned round, moved on by one, first two and last two changed."""
    n = F.size(items)
    last = F.concat(F.slice(items, F.lit(1), n - 2), F.array(F.element_at(items, -1), F.element_at(items, -2)))
    first = F.concat(F.array(F.get(items, F.lit(1)), F.get(items, F.lit(0))), F.slice(items, F.lit(3), n))
    return F.array(F.reverse(items), F.concat(F.slice(items, F.lit(2), n), F.array(F.get(items, F.lit(0)))), first, last)


def depth_questions(depths: DataFrame, kind: str, mcq: bool, keys: list[str], name: str = "name", objects: int = 4, seed: int = 0) -> DataFrame:
    """One question of each key's objects (keys, name, depth), near to far: kind "ordering" or "choice".

    Up to `objects` objects of a key are taken by hash; keys with fewer than three (four for a choice
    among options) go. Ordering: the answer is the order, or the letter of it among three wrong ones.
    Choice: 40 % ask for the farthest, 40 % for the closest, the rest for the n-th closest. Columns:
    keys, asked (names in hash order), ordered, kind, options, answer, prompt, messages.
    """
    least = 4 if mcq and kind == "choice" else 3
    some = sampling.sample(depths, keys, objects, seed, name)
    one = F.struct(F.round("depth", 6).alias("d"), F.col(name).alias("name"))
    q = some.groupBy(*keys).agg(F.sort_array(F.collect_list(one)).alias("x")).where(F.size("x") >= least)  # `objects` at most
    q = q.select(*keys, F.transform("x", lambda s: s["name"]).alias("ordered"))
    h = [F.lit(seed), *map(F.col, keys)]
    q = q.withColumn("asked", _some(F.col("ordered"), objects, *h, F.lit("asked")))
    listed, n = F.array_join("asked", ", "), F.size("ordered")
    values = {"T": F.lit("objects")}
    if kind == "ordering":
        right = F.array_join("ordered", ", ")
        q = q.withColumn("kind", F.lit("ordering"))
        if mcq:
            wrong = F.transform(_some(wrong_orders(F.col("ordered")), 3, *h, F.lit("wrong")), lambda o: F.array_join(o, ", "))
            q = q.withColumn("options", _some(F.concat(F.array(right), wrong), 4, *h, F.lit("options")))
    else:
        f = F.pmod(F.xxhash64(*h, F.lit("kind")), F.lit(10))
        q = q.withColumn("kind", F.when(f < 4, "farthest").when(f < 8, "closest").otherwise("choice"))
        at = F.when(F.col("kind") == "farthest", n - 1).when(F.col("kind") == "closest", 0).otherwise(F.pmod(F.xxhash64(*h, F.lit("nth")), n)).cast("int")
        q = q.withColumn("at", at)
        right = F.get("ordered", F.col("at"))
        nth = F.get(F.array(*map(F.lit, ORDINALS)), F.col("at"))
        values |= {"B": nth} if not mcq else {}
        if mcq:
            others = F.filter("ordered", lambda _, i: i != F.col("at"))
            q = q.withColumn("options", _some(F.concat(F.array(right), _some(others, 3, *h, F.lit("wrong"))), 4, *h, F.lit("options")))
    if mcq:
        q = q.where(F.size(F.array_distinct("options")) == 4).withColumn("answer", F.element_at(F.array(*map(F.lit, LETTERS)), F.array_position("options", right).cast("int")))
        shown = _lettered(F.col("options"))
        values |= {"X": listed, "A": F.col("answer"), "Y": shown} if kind == "ordering" else {"X": listed, "A": F.col("answer"), "Z": shown, "Y": F.when(F.col("kind") == "choice", nth).otherwise(shown)}
    else:
        q = q.withColumn("options", F.lit(None).cast("array<string>")).withColumn("answer", right)
        values |= {"A": listed, "X": F.col("answer")}
    names = ["depth.ordering"] if kind == "ordering" else ["depth.farthest", "depth.closest", "depth.choice"]
    tail = "_mcq" if mcq else ""
    prompt = templates.any_prompt(F.concat(F.lit("depth."), "kind", F.lit(tail)), [x + tail for x in names], F.concat_ws("/", *keys), values)
    return _messages(q, prompt, 1).select(*keys, "asked", "ordered", "kind", "options", "answer", "prompt", "messages")


def chain_members(chains: DataFrame, length: int) -> DataFrame:
    """(scene_id, place, node_id, view_idx): a row a step of sampling.chains."""
    steps = F.array(*[F.struct(F.lit(i).alias("place"), F.col(f"node_{i}").alias("node_id"), F.col(f"view_{i}").alias("view_idx")) for i in range(length)])
    return chains.select("scene_id", F.explode(steps).alias("x")).select("scene_id", "x.place", "x.node_id", "x.view_idx")


def _ends(members: DataFrame) -> DataFrame:
    """(scene_id, node_a, node_b): the two nodes of a chain of two."""
    return members.groupBy("scene_id").agg(F.min_by("node_id", "place").alias("node_a"), F.max_by("node_id", "place").alias("node_b"))


def _named(df: DataFrame, nodes: DataFrame, *columns: str) -> DataFrame:
    """df with the lower-case tag of each node column as <column>_tag."""
    for c in columns:
        df = df.join(nodes.select("scene_id", F.col("node_id").alias(c), F.lower("tag").alias(f"{c}_tag")), ["scene_id", c])
    return df


def chain_distance(members: DataFrame, nodes: DataFrame, clouds: DataFrame, seed: int = 0) -> DataFrame:
    """Distance of the two objects of a chain of two, seen in different views: (scene_id, node_a, node_b,
    distance, unit, answer, prompt, messages). clouds: (scene_id, node_id, p_*), rid of outliers."""
    pair = _ends(members)
    cloud = lambda c: clouds.select("scene_id", F.col("node_id").alias(c), "p_x", "p_y", "p_z").join(pair, ["scene_id", c])
    d = points.nearest_distance(cloud("node_a"), cloud("node_b"), ["scene_id", "node_a", "node_b"])
    d = _named(d, nodes, "node_a", "node_b")
    d = d.withColumn("unit", sampling.choice(["m", "cm"], seed, "scene_id"))
    d = d.withColumn("answer", F.format_string("%.2f %s", F.col("distance") * F.when(F.col("unit") == "cm", 100.0).otherwise(1.0), "unit"))
    values = {"A": F.col("node_a_tag"), "B": F.col("node_b_tag"), "X": F.col("answer")}
    prompt = templates.any_prompt(F.concat(F.lit("distance.absolute_"), "unit"), ["distance.absolute_m", "distance.absolute_cm"], F.col("scene_id").cast("string"), values)
    return _messages(d, prompt, 2).select("scene_id", "node_a", "node_b", "distance", "unit", "answer", "prompt", "messages")


def chain_extreme_distance(members: DataFrame, nodes: DataFrame, clouds: DataFrame, length: int, seed: int = 0) -> DataFrame:
    """Which object of a chain of 3 to 6 is closest to, or farthest from, another of it: (scene_id, node_ref,
    kind, nearest first `others`, node_answer, answer, prompt, messages). Equal distances: the smaller id."""
    ref_place = F.pmod(F.xxhash64(F.lit(seed), "scene_id"), F.lit(length))
    ref = members.where(F.col("place") == ref_place).select("scene_id", F.col("node_id").alias("node_ref"))
    other = members.where(F.col("place") != ref_place).select("scene_id", F.col("node_id").alias("node_b")).join(ref, "scene_id")
    a = clouds.select("scene_id", F.col("node_id").alias("node_ref"), "p_x", "p_y", "p_z").join(other, ["scene_id", "node_ref"])
    b = clouds.select("scene_id", F.col("node_id").alias("node_b"), "p_x", "p_y", "p_z").join(other, ["scene_id", "node_b"])
    d = _named(points.nearest_distance(a, b, ["scene_id", "node_ref", "node_b"]), nodes, "node_ref", "node_b")
    item = F.struct(F.round("distance", 6).alias("d"), F.col("node_b").alias("node"), F.col("node_b_tag").alias("tag"))
    q = d.groupBy("scene_id", "node_ref", "node_ref_tag").agg(F.sort_array(F.collect_list(item)).alias("others")).where(F.size("others") == length - 1)  # of one chain
    q = q.withColumn("kind", sampling.choice(["closest", "farthest"], seed + 1, "scene_id"))
    most = F.element_at("others", -1)["d"]
    best = F.when(F.col("kind") == "closest", F.get("others", F.lit(0))).otherwise(F.get(F.filter("others", lambda o: o["d"] == most), F.lit(0)))
    q = q.withColumn("best", best)
    listed = F.array_join(_some(F.transform("others", lambda o: o["tag"]), length, F.lit(seed), F.col("scene_id")), ", ")
    values = {"T": listed, "X": F.col("node_ref_tag"), "A": F.col("best.tag")}
    prompt = templates.any_prompt(F.concat(F.lit("distance."), "kind"), ["distance.closest", "distance.farthest"], F.col("scene_id").cast("string"), values)
    q = _messages(q, prompt, length)
    return q.select("scene_id", "node_ref", "kind", F.transform("others", lambda o: o["node"]).alias("others"), F.col("best.node").alias("node_answer"), F.col("best.tag").alias("answer"), "prompt", "messages")


def chain_size(members: DataFrame, nodes: DataFrame, seed: int = 0) -> DataFrame:
    """Is the first object of a chain of two bigger (or smaller) than the second? Equal volumes count as
    smaller. (scene_id, node_a, node_b, kind, answer, prompt, messages)."""
    v = nodes.select("scene_id", "node_id", F.round(tasks.volume(), 9).alias("v"))
    q = _named(_ends(members), nodes, "node_a", "node_b")
    for c in ("node_a", "node_b"):
        q = q.join(v.select("scene_id", F.col("node_id").alias(c), F.col("v").alias(f"{c}_v")), ["scene_id", c])
    q = q.withColumn("kind", sampling.choice(["big", "small"], seed, "scene_id"))
    bigger = F.col("node_a_v") > F.col("node_b_v")
    q = q.withColumn("answer", F.when((F.col("kind") == "big") == bigger, "Yes").otherwise("No"))
    values = {"A": F.col("node_a_tag"), "B": F.col("node_b_tag"), "X": F.col("answer")}
    prompt = templates.any_prompt(F.concat(F.lit("size."), "kind", F.lit(".multi_view")), ["size.big.multi_view", "size.small.multi_view"], F.col("scene_id").cast("string"), values)
    return _messages(q, prompt, 2).select("scene_id", "node_a", "node_b", "kind", "answer", "prompt", "messages")


def chain_extreme_size(members: DataFrame, nodes: DataFrame, length: int, seed: int = 0) -> DataFrame:
    """The biggest or smallest object of a chain of 3 to 6: (scene_id, kind, node_answer, answer, prompt,
    messages). Equal volumes: the smaller id."""
    v = members.join(nodes.select("scene_id", "node_id", F.round(tasks.volume(), 9).alias("v"), F.lower("tag").alias("tag")), ["scene_id", "node_id"])
    one = F.struct("node_id", "tag")
    q = v.groupBy("scene_id").agg(F.max_by(one, F.struct("v", -F.col("node_id"))).alias("biggest"), F.min_by(one, F.struct("v", "node_id")).alias("smallest"), F.array_join(F.sort_array(F.collect_list("tag")), ", ").alias("tags"))
    q = q.withColumn("kind", sampling.choice(["biggest", "smallest"], seed, "scene_id"))
    q = q.withColumn("best", F.when(F.col("kind") == "biggest", F.col("biggest")).otherwise(F.col("smallest")))
    prompt = templates.any_prompt(F.concat(F.lit("size."), "kind"), ["size.biggest", "size.smallest"], F.col("scene_id").cast("string"), {"T": F.col("tags"), "X": F.col("best.tag")})
    return _messages(q, prompt, length).select("scene_id", "kind", F.col("best.node_id").alias("node_answer"), F.col("best.tag").alias("answer"), "prompt", "messages")


def object_positions(views: DataFrame, nodes: DataFrame, seen: DataFrame, delta: float = 15.0, quota: int | None = None, seed: int = 0) -> DataFrame:
    """Where an object of view b lies from an anchor that both views see, if an object of view a lies to the
    north of it: (scene_id, a_view_idx, b_view_idx, anchor, node_a, node_b, dx, dy, answer).

    The tag of node_a is in view a only, that of node_b in view b only (the smallest id of a tag and
    view); no two of the three footprints overlap. With a quota only so many (views, anchor) of a scene
    meet the objects.
    """
    # One row a scene, with its views and what they see: all else is loops over its lists, in generated code,
    # so neither pairs of views nor their objects are shuffled.
    near = kernels.footprint_overlaps(nodes)
    sides = F.explode(F.array(F.struct(F.col("a_node_id").alias("node_id"), F.col("b_node_id").alias("o")), F.struct(F.col("b_node_id").alias("node_id"), F.col("a_node_id").alias("o"))))
    near = near.select("scene_id", sides.alias("x")).groupBy("scene_id", "x.node_id").agg(F.collect_set("x.o").alias("near"))
    own = F.array("node_id")  # a node is too near to itself
    known = nodes.select("scene_id", "node_id", "tag", "c_x", "c_y").join(near, ["scene_id", "node_id"], "left")
    known = known.withColumn("near", F.when(F.col("near").isNull(), own).otherwise(F.concat("near", own)))
    known = known.groupBy("scene_id").agg(F.collect_list(F.struct("node_id", "tag", "c_x", "c_y", "near")).alias("known"))
    there = views.groupBy("scene_id").agg(F.collect_set("view_idx").alias("there"))
    lists = seen.groupBy("scene_id", "view_idx").agg(F.collect_set("node_id").alias("ids"))
    lists = lists.groupBy("scene_id").agg(F.collect_list(F.struct("view_idx", "ids")).alias("views"))
    s = lists.join(there, "scene_id").join(known, "scene_id")
    v = s.select("scene_id", F.transform(F.filter("views", lambda v: F.array_contains("there", v["view_idx"])), lambda v: F.struct(v["view_idx"].alias("view_idx"), F.filter("known", lambda n: F.array_contains(v["ids"], n["node_id"])).alias("nodes"))).alias("views"))
    first = lambda nodes: F.filter(nodes, lambda x: ~F.exists(nodes, lambda y: y["tag"].eqNullSafe(x["tag"]) & (y["node_id"] < x["node_id"])))
    one = lambda v: F.struct(v["view_idx"].alias("view_idx"), v["nodes"].alias("nodes"), v["nodes"]["node_id"].alias("ids"), v["nodes"]["tag"].alias("tags"), first(v["nodes"]).alias("firsts"))
    v = v.select("scene_id", F.transform("views", one).alias("views"))
    has = lambda items, x: F.coalesce(F.array_contains(items, x), F.lit(False))
    c = F.col
    q = v.select("*", F.explode("views").alias("a")).select("*", F.explode("views").alias("b")).where("a.view_idx < b.view_idx")
    q = q.select("scene_id", "a", "b", F.explode("a.nodes").alias("o")).where(has(c("b.ids"), c("o.node_id")))
    q = q.withColumns({"a_view_idx": c("a.view_idx"), "b_view_idx": c("b.view_idx"), "anchor": c("o.node_id")})
    q = tasks._some_pairs(q, quota, seed, "a_view_idx", "b_view_idx", "anchor")
    q = q.select("*", F.explode("a.firsts").alias("m")).where(~has(c("b.tags"), c("m.tag")) & ~has(c("o.near"), c("m.node_id")))
    q = q.select("*", F.explode("b.firsts").alias("n")).where(~has(c("a.tags"), c("n.tag")) & ~has(c("o.near"), c("n.node_id")) & ~has(c("m.near"), c("n.node_id")))
    toward = F.degrees(F.atan2(c("m.c_x") - c("o.c_x"), c("m.c_y") - c("o.c_y")))
    dx, dy = g.turned(c("n.c_x") - c("o.c_x"), c("n.c_y") - c("o.c_y"), toward)
    q = q.select("scene_id", "a_view_idx", "b_view_idx", "anchor", c("m.node_id").alias("node_a"), c("n.node_id").alias("node_b"), F.round(dx, 9).alias("dx"), F.round(dy, 9).alias("dy"))
    return q.withColumn("answer", g.compass(c("dx"), c("dy"), delta))


def correspondence_questions(matches: DataFrame, keys: list[str], mcq: bool, size: tuple[int, int] = (64, 48), margin: int = 10, apart: float = 8.0, seed: int = 0) -> DataFrame:
    """One question of each key's matches (annotate.correspondences): which marked point of the second image
    shows the point (u, v) of the first?

    The right point stands among three others, `apart` pixels from it at least, in hash order; labels are
    numbers for three keys in ten, else letters. Columns: keys, u, v, points, labels, right, answer,
    prompt, messages. Keys without room for three others go.
    """
    h = [F.lit(seed), *map(F.col, keys)]
    m = sampling.sample(matches, keys, 1, seed, "u", "v", "u2", "v2")
    far = lambda s: (s["u"] - F.col("u2")) ** 2 + (s["v"] - F.col("v2")) ** 2 >= apart**2
    draw = lambda i, c, n: (F.pmod(F.xxhash64(*h, i, F.lit(c)), F.lit(n - 2 * margin)) + margin).cast("long")
    tries = F.transform(F.sequence(F.lit(1), F.lit(100)), lambda i: F.struct(draw(i, "u", size[0]).alias("u"), draw(i, "v", size[1]).alias("v")))
    m = m.withColumn("others", F.slice(F.array_distinct(F.filter(tries, far)), 1, 3)).where(F.size("others") == 3)
    true = F.struct(F.col("u2").cast("long").alias("u"), F.col("v2").cast("long").alias("v"))
    m = m.withColumn("points", _some(F.concat(F.array(true), F.col("others")), 4, *h, F.lit("order")))
    m = m.withColumn("numbers", F.pmod(F.xxhash64(*h, F.lit("labels")), F.lit(10)) < 3)
    m = m.withColumn("labels", F.when(F.col("numbers"), F.array(*map(F.lit, "1234"))).otherwise(F.array(*map(F.lit, LETTERS))))
    m = m.withColumn("right", F.element_at("labels", F.array_position("points", true).cast("int")))
    point = F.concat(F.lit("point-"), "right")
    if mcq:
        listed = F.array_join(F.transform("labels", lambda x, i: F.concat(F.substring(F.lit(LETTERS), i + 1, F.lit(1)), F.lit(" point-"), x)), " ")
        answer = F.concat(F.element_at(F.array(*map(F.lit, LETTERS)), F.array_position("labels", F.col("right")).cast("int")), F.lit(" "), point)
        tail = F.concat(F.lit(" \nOptions: "), listed)
    else:
        bare = ~F.col("numbers") & (F.pmod(F.xxhash64(*h, F.lit("bare")), F.lit(10)) >= 7)
        answer, tail = F.when(bare, F.col("right")).otherwise(point), F.lit("")
    m = m.withColumn("answer", answer)
    name = F.when(F.col("numbers"), "correspondence.point2point_num").otherwise("correspondence.point2point")
    values = {"A": F.lit("red"), "B": F.lit("blue"), "T": F.col("answer")}
    prompt = templates.any_prompt(name, ["correspondence.point2point_num", "correspondence.point2point"], F.concat_ws("/", *keys), values)
    prompt = F.concat(F.substring_index(prompt, f" {text.ANSWER}", 1), tail, F.lit(f" {text.ANSWER}"), F.col("answer"))
    return _messages(m, prompt, 2).select(*keys, "u", "v", "points", "labels", "right", "answer", "prompt", "messages")


def pose_questions(views: DataFrame, nodes: DataFrame, seen: DataFrame, min_rotation: float = 15.0, min_translation: float = 0.0, seed: int = 0) -> DataFrame:
    """Which of four maps shows where three views were taken: (scene_id, views, maps, answer, prompt,
    messages). Views are three that differ in pose from each other; the map holds them and what they see;
    the wrong ones have their cameras moved (bev.PERTURBATIONS)."""
    three = sampling.diverse_views(views, 3, min_rotation, min_translation, seed)
    chosen = views.join(three.select("scene_id", "view_idx"), ["scene_id", "view_idx"], "left_semi")
    near = seen.join(three.select("scene_id", "view_idx"), ["scene_id", "view_idx"], "left_semi").select("scene_id", "node_id").distinct()
    options = bev.pose_options(chosen, nodes.join(near, ["scene_id", "node_id"], "left_semi"), seed)
    maps = options.groupBy("scene_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("option", "map"))), lambda o: o["map"]).alias("maps"), F.max(F.when(F.col("right"), F.col("option"))).alias("answer"))  # four
    listed = three.groupBy("scene_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "view_idx"))), lambda o: o["view_idx"]).alias("views"))  # three
    q = listed.join(maps, "scene_id")
    prompt = templates.prompt("bev_pose.mcq", F.col("scene_id").cast("string"), {"O": F.lit(" / ".join(LETTERS)), "A": F.col("answer")})
    return _messages(q, prompt, 7).select("scene_id", "views", "maps", "answer", "prompt", "messages")


#: How often a part of a caption request is left out.
LEFT_OUT = {"role": 0.1, "task": 0.0, "subject": 0.2, "technical": 0.5, "text": 0.0, "constraint": 0.4, "style": 0.2}
#: Parts of a request for a caption, in their order.
CAPTION = {
    "role": ("You describe rooms for people who cannot see them.", "You write captions of interiors."),
    "task": ("Describe this scene in one paragraph.", "Write down what this room looks like."),
    "subject": ("Name the main objects and where they stand to each other.", "Say what stands where."),
    "technical": ("Mention light and the place of the camera.", "Say from where the picture was taken."),
    "text": ("Quote any writing that can be read.",),
    "constraint": ("Do not guess what cannot be seen.", "Leave out what is uncertain."),
    "style": ("Use plain words.", "Write short sentences."),
}


def caption_requests(records: DataFrame, key: str = "id", seed: int = 0) -> DataFrame:
    """records with `request`, what a captioner is asked: a wording of each part, parts left out by hash.

    The captioner itself is a plug-in (kernels.Model), which reads image and request and gives the caption;
    caption_answers makes messages of them.
    """
    parts = []
    for name, texts in CAPTION.items():
        left = F.pmod(F.xxhash64(F.lit(seed), F.lit(name), F.col(key)), F.lit(1000)) / 1000.0 < LEFT_OUT[name]
        text_ = F.get(F.array(*map(F.lit, texts)), F.pmod(F.xxhash64(F.lit(seed + 1), F.lit(name), F.col(key)), F.lit(len(texts))).cast("int"))
        parts.append(F.when(~left, text_))
    return records.withColumn("request", F.concat_ws(" ", *parts))


def caption_answers(captioned: DataFrame, caption: str = "caption") -> DataFrame:
    """Rows of request and caption as question records; rows without a caption go."""
    df = captioned.where(F.col(caption).isNotNull())
    return _messages(df, F.concat("request", F.lit(f" {text.ANSWER}"), caption), 1)
