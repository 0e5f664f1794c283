"""Reshaping operators on small hand-made tables, error paths included."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vistaloom.functions import text as tx
from vistaloom.operators import annotate, bev, graph, points, sampling, tables


def test_flatten(spark):
    df = spark.createDataFrame([("s", ["a", "b"], [1, 2], 7), ("t", [], [], 8)], "scene_id string, tags array<string>, ids array<int>, n int")
    assert [tuple(r) for r in tables.flatten(df, "tags", ["ids"]).collect()] == [("s", "a", 1, 7), ("s", "b", 2, 7)]
    with pytest.raises(ValueError):
        tables.flatten(df, "tags", ["nope"])
    with pytest.raises(ValueError):
        tables.flatten(df, "tags", ["n"])
    with pytest.raises(PySparkException):
        tables.flatten(spark.createDataFrame([(["a"], [1, 2])], "tags array<string>, ids array<int>"), "tags", ["ids"]).collect()
    scalar = spark.createDataFrame([("a", 1)], "tags string, ids int")
    assert tables.flatten(scalar, "tags", ["ids"]).collect() == scalar.collect()


def test_group_keeps_order_and_nulls(spark):
    rows = [("a", 0, "x", 1), ("b", 1, "y", 2), ("a", 2, None, 3)]
    df = spark.createDataFrame(rows, "scene_id string, ord int, box string, first int")
    got = {r.scene_id: (r.first, r.box) for r in tables.group(df.repartition(3), "scene_id", ["box"], "ord").collect()}
    assert got == {"a": (1, ["x", None]), "b": (2, ["y"])}
    with pytest.raises(ValueError):
        tables.group(df, "scene_id", ["nope"], "ord")
    with pytest.raises(PySparkException):
        tables.group(spark.createDataFrame([(None, 0, "x")], "scene_id string, ord int, box string"), "scene_id", ["box"], "ord").collect()


def test_group_then_flatten_is_the_same(spark):
    df = spark.createDataFrame([(f"s{i % 3}", i, float(i)) for i in range(20)], "scene_id string, ord int, x double")
    g = tables.group(df.withColumn("o", F.col("ord")), "scene_id", ["o", "x"], "ord")
    back = tables.flatten(g, "o", ["x"]).select("scene_id", F.col("o").alias("ord"), "x")
    assert sorted(back.collect()) == sorted(df.collect())


def test_merge_and_counts(spark):
    f = spark.createDataFrame([("s", 0, "d", "i0"), ("s", 1, "d", "i1")], "scene_id string, view_idx int, dataset string, image string")
    m = tables.merge_scenes(f)
    assert m.first().asDict() == {"scene_id": "s", "dataset": "d", "image": ["i0", "i1"], "num_images": 2}
    assert tables.counts_agree(m, f).first().agree


def test_flatten_qa(spark):
    df = spark.createDataFrame([("i", ["q", "r"], ["MCQ", None], []), ("j", [], None, None)], "image string, messages array<string>, question_types array<string>, question_tags array<string>")
    assert [tuple(r) for r in tables.flatten_qa(df).collect()] == [("i", 0, "q", None, "MCQ"), ("i", 1, "r", None, None)]
    with pytest.raises(PySparkException):
        tables.flatten_qa(spark.createDataFrame([(["q"], ["a", "b"])], "messages array<string>, question_types array<string>")).collect()


def test_tag_filter_keeps_lists_aligned(spark):
    df = spark.createDataFrame([(["wall", "chair", None], [1, 2, 3]), (["wall"], [1])], "obj_tags array<string>, ids array<int>")
    assert [tuple(r) for r in tables.without_tags(df, ("wall",), ["ids"]).collect()] == [(["chair", None], [2, 3])]
    f = spark.createDataFrame([([True, False], [1, 2], [1, 2, 3])], "keep array<boolean>, a array<int>, b array<int>")
    assert tuple(tables.by_flags(f, "keep").first()) == ([True, False], [1], [1, 2, 3])


def test_kept_boxes(spark):
    rows = [(1, 0, "t", 0, 0, 10, 10), (1, 1, "t", 0, 0, 10, 9), (1, 2, "u", 0, 0, 10, 10), (1, 3, "t", 5, 0, 15, 10), (2, 0, "t", 0, 0, 4, 4), (2, 1, "t", 0, 0, 4, 4), (3, 0, "t", 0, 0, 0, 4)]
    df = spark.createDataFrame(rows, "frame_id int, obj_idx int, tag string, x1 int, y1 int, x2 int, y2 int")
    assert sorted((r.frame_id, r.obj_idx) for r in tables.kept_boxes(df).collect()) == [(1, 0), (1, 2), (1, 3), (2, 0), (3, 0)]


def test_funnel_and_failures(spark):
    c = spark.createDataFrame([("p", 0, "a", 1000), ("p", 1, "b", 15), ("p", 2, "c", 0)], "part string, stage_no int, stage string, n_rows long")
    assert [r.level for r in tables.funnel(c).orderBy("stage_no").collect()] == ["ok", "warn", "strong"]
    log = spark.createDataFrame([(i, "bad" if i % 2 else "ok") for i in range(50)], "id int, status string")
    counts, first = tables.failures(log, most=3)
    assert {r.status: r.n for r in counts.collect()} == {"bad": 25, "ok": 25} and first.count() == 6


def test_numbered_on_files_of_many_rows(spark, tmp_path):
    df = spark.range(400_000).select((F.col("id") * 7919 % 400_000).alias("k"), F.xxhash64("id").alias("__p"), F.lit("x").alias("other"))
    tables.numbered(df, "k", ranges=16).write.parquet(f"{tmp_path}/n")
    back = spark.read.parquet(f"{tmp_path}/n")
    r = back.agg(F.countDistinct("flat_idx").alias("n"), F.min("flat_idx").alias("lo"), F.max("flat_idx").alias("hi"), F.sum((F.col("k") != F.col("flat_idx")).cast("int")).alias("bad")).first()
    assert (r.n, r.lo, r.hi, r.bad) == (400_000, 0, 399_999, 0) and back.columns == ["k", "__p", "other", "flat_idx"]
    tied = tables.numbered(df.withColumn("k", F.col("k") % 3), "k", ranges=16)
    assert tied.agg(F.countDistinct("flat_idx")).first()[0] == 400_000


def test_small_checks(spark):
    df = spark.createDataFrame([("a", ["x", "y", "x"], "d", ["m"]), ("b", ["x"], "d", ["m"]), ("c", ["x", "y", "z"], None, ["m"]), ("d", None, "d", None)], "id string, obj_tags array<string>, depth_map string, masks array<string>")
    assert [(r.counting, r.depth) for r in tables.task_checks(df).orderBy("id").collect()] == [(True, True), (False, False), (True, False), (False, False)]
    assert tables.task_checks(df.drop("masks")).where("depth").count() == 0
    rows = {r.depth_map: r.id for r in tables.first_seen(df.select("depth_map", "id"), ["depth_map"], "id").collect()}
    assert rows == {"d": "a", None: "c"}
    tag = df.select(tables.gathered_tag(F.when(F.col("id") == "a", "wall").when(F.col("id") == "b", "lamp"), F.when(F.col("id") != "c", F.upper("id")).otherwise("Unknown")).alias("t"), "id").orderBy("id")
    assert [r.t for r in tag.collect()] == ["A", "lamp", "Unknown", "D"]
    flat = tables.limited(spark.range(100).select((F.col("id") % 10).alias("g"), "id"), "g", 3, 12, ("id",))
    assert {r.g for r in flat.collect()} == {0, 1} and flat.count() == 12
    have = spark.createDataFrame([("d",)], "path string")
    assert [(r.id, r.field) for r in tables.missing_paths(df, have, ("depth_map",)).collect()] == []
    assert [(r.id, r.path) for r in tables.missing_paths(df.withColumn("depth_map", F.lit("e")).where("id = 'a'"), have, ("depth_map",)).collect()] == [("a", "e")]
    f = {n: spark.createDataFrame([(1, x) for x in xs], "scene_id int, frame_name string") for n, xs in (("rgb", "abcd"), ("depth", "abd"), ("pose", "bdx"))}
    assert sorted(r.frame_name for r in tables.complete_frames(f, "rgb").collect()) == ["b", "d"]
    nested = spark.createDataFrame([([["a", "b"], ["a"]],), ([["b", "a"], []],)], "tag array<array<string>>")
    assert [tuple(r) for r in tables.tag_histogram(nested, 2).collect()] == [("a", 3), ("b", 2)]


def test_round_robin_over_pairs(spark):
    rows = [(a, v, w, k) for a in range(3) for v, w in ((1, 2), (2, 1), (1, 3), (3, 4)) for k in range(5)]
    df = spark.createDataFrame(rows, "a int, v int, w int, k int")
    got = sampling.round_robin(df, ["a"], 9, 2, "v", "w", "k", pair=("v", "w")).collect()
    pairs = [tuple(sorted((r.v, r.w))) for r in got]
    assert all(sorted(p for r, p in zip(got, pairs) if r.a == a) == [(1, 2), (1, 3), (3, 4)] for a in range(3))
    assert sampling.round_robin(df, ["a"], 1000, 2, "v", "w", "k", pair=("v", "w")).count() == 60


def test_colours(spark):
    got = spark.createDataFrame([("Gold ring", "x"), ("silver", "x"), ("grey", "x"), ("lamp", "红色"), ("desk", "桌")], "t string, l string").select(tx.is_colour(F.col("t"), F.col("l")).alias("c")).collect()
    assert [r.c for r in got] == [True, True, False, True, False]


def test_numbered_is_gapless(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    assert [(r.k, r.flat_idx) for r in tables.numbered(df, "k", ranges=7).orderBy("k").collect()] == [(i, i) for i in range(1000)]


def test_records_and_resume(spark):
    r = spark.createDataFrame([("a", None, 5), ("b", "x", 1000)], "id string, image string, depth_scale int")
    assert sorted(tuple(x) for x in tables.invalid_records(r, ("image",)).collect()) == [("a", "depth_scale"), ("a", "missing image")]
    assert [x.id for x in tables.not_done(r, r.where("id = 'a'"), "id").collect()] == ["b"]
    look = spark.createDataFrame([(1, "one"), (1, "uno")], "k int, label string")
    assert sorted(tuple(x) for x in tables.with_lookup(spark.createDataFrame([(1,), (2,)], "k int"), look, "k", "label").collect()) == [(1, "one"), (2, "Unknown")]


def test_scene_tables(spark):
    box, zero, minus = [1.0] * 9, [0.0] * 9, [-0.0] + [0.0] * 8
    rows = [("s", [["a", "b"], ["c", "n"], ["z", "z"]], [[box, None], [box, None], [zero, minus]])]
    df = spark.createDataFrame(rows, "scene_id string, obj_tags array<array<string>>, bboxes_3d_world_coords array<array<array<double>>>")
    nodes, seen = graph.scene_tables(df)
    assert sorted(r.tag for r in nodes.collect()) == ["a", "b", "n", "z", "z"]
    key = {r.tag: r.node_key for r in nodes.collect()}
    assert sorted(r.view_idx for r in seen.collect() if r.node_key == key["a"]) == [0, 1]
    with pytest.raises(ValueError):
        graph.scene_tables(df.drop("obj_tags"))


def test_messages(spark):
    def m(p, n=1):
        r = spark.range(1).select(tx.messages(F.lit(p), F.lit(n)).alias("m")).first().m
        return r and [(x["from"], x["value"]) for x in r]

    assert m("no answer") is None
    assert m("Q? Answer: a Answer: b", 2) == [("human", "<image><image>Q?"), ("gpt", "a Answer: b")]
    r = spark.range(1).select(tx.multi_turn(F.array(F.lit("skipped"), F.lit("Q Answer: A")), F.lit(1)).alias("m")).first().m
    assert [x["value"] for x in r] == ["Q", "A"]


@pytest.mark.parametrize("text,kind", [("A. x", "MCQ"), ("(B)", "MCQ"), ("A:3", "open"), ("A.north", "open"), ("A point-A", "open")])
def test_output_type(spark, text, kind):
    assert spark.range(1).select(tx.output_type(F.lit(text))).first()[0] == kind


def test_words(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(tx.metric(F.lit(0.256))) == "25.60 centimeters" and one(tx.metric(F.lit(1.5))) == "1.50 meters"
    assert one(tx.clean_name(F.lit("SM_01_LampABC"))) == "lamp" and one(tx.clean_name(F.lit("12"))) == ""
    assert one(tx.fill(F.lit("[X] and [Y]"), {"X": F.lit("a"), "Y": F.lit("b")})) == "a and b"
    assert one(tx.is_rotated(F.lit(" ARKitScenes_v2"))) and not one(tx.is_rotated(F.lit(None).cast("string")))
    assert one(tx.is_colour(F.lit("Dark Red"), F.lit("x"))) and one(tx.is_colour(F.lit("x"), F.lit("红色"))) and not one(tx.is_colour(F.lit("chair"), F.lit("椅")))


def test_front_depth(spark):
    rows = [(n, float(d)) for n in (5, 10, 25) for d in range(n + 1)]
    got = {r.k0: (r.n, r.k, r.depth) for r in points.front_depth(spark.createDataFrame(rows, "k0 int, d double"), ["k0"]).collect()}
    assert got == {5: (5, 1, 1.0), 10: (10, 1, 1.0), 25: (25, 2, 1.5)}
    ties = spark.createDataFrame([(1, 2.0)] * 30 + [(1, 4.0)] * 10, "k0 int, d double")
    assert points.front_depth(ties, ["k0"]).first().depth == 2.0


def test_backprojection(spark):
    px = spark.createDataFrame([(u, v, 1.0) for v in (0, 1) for u in (0, 1)], "u int, v int, d double")
    got = [(r.p_x, r.p_y, r.p_z) for r in points.back_projected(px, 1, 1, 0, 0).collect()]
    assert got == [(0, 0, 1), (1, 0, 1), (0, 1, 1), (1, 1, 1)]


def test_range_join_and_inliers(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    p, q = np.round(rng.uniform(0, 1, (300, 3)), 2), np.round(rng.uniform(0, 1, (300, 3)), 2)
    frame = lambda x: spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "i int, p_x double, p_y double, p_z double")
    got = points.range_join(frame(p), frame(q).withColumnRenamed("i", "j"), 0.1).select("i", "j").collect()
    want = {(i, j) for i in range(300) for j in range(300) if round(float(np.linalg.norm(p[i] - q[j])), 9) <= 0.1}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    cloud = np.concatenate([rng.normal(0, 0.1, (200, 3)), [[9, 9, 9]]])
    kept = points.inliers(frame(cloud).withColumn("k", F.lit(1)), ["k"], 10, 2.0).collect()
    assert 200 not in {r.i for r in kept} and len(kept) > 180


def test_map_of_one_camera(spark):
    e = spark.createDataFrame([(1, "camera", 0, 2.0, 3.0, 0.0, 0.0, 0.0), (2, "camera", 0, 1.0, 1.0, 0.0, 0.0, 90.0), (2, "object", 5, 1.0, 1.0, 0.0, 0.0, 0.0)], "scene_id int, kind string, entity_id int, x double, y double, half_x double, half_y double, yaw double")
    b = {r.scene_id: (r.xmin, r.xmax) for r in bev.bounds(e).collect()}
    assert b[1] == pytest.approx((1.4, 2.6))
    p = bev.placed(e, bev.bounds(e))
    assert sorted(r.n for r in bev.occupancy(p).collect()) == [1, 2]
    assert {(r.scene_id, r.kind): r.facing for r in p.collect()} == {(1, "camera"): "right", (2, "camera"): "down", (2, "object"): "right"}
    m = bev.grids(p).where("scene_id = 2").first()
    assert sum(map(sum, m.cells)) == 2 and m.objects[0].facing is None
    back = bev.perturbed(bev.perturbed(e, bev.bounds(e), "mirror_x"), bev.bounds(e), "mirror_x")
    assert sorted((r.scene_id, round(r.x, 9)) for r in back.collect()) == sorted((r.scene_id, r.x) for r in e.collect())
    assert m.cameras[0].name == "Image 1"


def test_perturbed_maps_keep_their_objects(spark):
    rows = [(s, "camera", i, float(i * i), float(-i), 0.0, 0.0, 10.0 * i) for s in range(4) for i in range(5)] + [(s, "object", i, 3.0 * i, 1.0 * i, 0.5, 0.5, 5.0) for s in range(4) for i in range(3)]
    e = spark.createDataFrame(rows, "scene_id int, kind string, entity_id int, x double, y double, half_x double, half_y double, yaw double")
    b = bev.bounds(e)
    lim = {r.scene_id: r for r in b.collect()}
    for op in bev.PERTURBATIONS:
        got = {(r.scene_id, r.kind, r.entity_id): r for r in bev.perturbed(e, b, op).collect()}
        assert len(got) == len(rows)
        for s, kind, i, x, y, _, _, yaw in rows:
            r, m = got[s, kind, i], lim[s]
            if kind == "object":
                assert (r.x, r.y, r.yaw) == (x, y, yaw)
            elif op != "shuffle":
                want = {"mirror_x": (m.xmin + m.xmax - x, y, 180 - yaw), "mirror_y": (x, m.ymin + m.ymax - y, -yaw), "rotate_180": (m.xmin + m.xmax - x, m.ymin + m.ymax - y, yaw + 180)}[op]
                assert (r.x, r.y, r.yaw) == pytest.approx(want)
            else:
                assert r.x != x and r.yaw == yaw
        if op == "shuffle":
            assert all({got[s, "camera", i].x for i in range(5)} == {float(i * i) for i in range(5)} for s in range(4))


def test_pose_options(spark):
    v = spark.createDataFrame([(s, i, 1.0 * i, 2.0 * i * i, 0.0, 1.0 + i, 1.0) for s in range(30) for i in range(3)], "scene_id int, view_idx int, pos_x double, pos_y double, pos_z double, fwd_x double, fwd_y double")
    n = spark.createDataFrame([(s, 7, 1.0, 1.0, 1.0, 1.0, 0.3) for s in range(30)], "scene_id int, node_id int, c_x double, c_y double, l_x double, l_y double, e2 double")
    rows = bev.pose_options(v, n).collect()
    assert len(rows) == 120 and {r.option for r in rows} == set("ABCD")
    ops = [sorted(r.op for r in rows if r.scene_id == s) for s in range(30)]
    assert all(len(set(o)) == 4 and "true" in o for o in ops) and len(set(map(tuple, ops))) == 4
    assert all(r.right == (r.op == "true") for r in rows) and len({r.option for r in rows if r.right}) == 4
    assert all(len({str(r.map) for r in rows if r.scene_id == s}) == 4 for s in range(30))


def test_sampling_repeats(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10).alias("k"))
    a = sampling.sample(df, ["k"], 3, 1, "id")
    assert a.count() == 30 and sorted(a.collect()) == sorted(sampling.sample(df.repartition(9), ["k"], 3, 1, "id").collect())
    rr = sampling.round_robin(df, ["k"], 25, 1, "id").collect()
    n = [sum(r.k == k for r in rr) for k in range(10)]
    assert len(rr) == 25 and max(n) - min(n) <= 1
    share = df.select(sampling.choice(["a", "b"], 3, "id", weights=[1, 3]).alias("c")).where("c = 'b'").count()
    assert 680 < share < 820
    w = df.select(F.col("k"), sampling.wrong_counts(F.col("k")).alias("w")).collect()
    assert all(len(set(r.w)) == 3 and r.k not in r.w and all(0 <= x and abs(x - r.k) <= 5 for x in r.w) for r in w)
    s = df.select("id", sampling.shuffled(F.array(F.lit("x"), F.lit("y"), F.lit("z")), 1, "id").alias("s")).collect()
    assert all(sorted(r.s) == ["x", "y", "z"] for r in s) and len({tuple(r.s) for r in s}) == 6


def test_diverse_views_and_chains(spark, sf_dir):
    from vistaloom.plans import fixtures as fx

    v = fx.views(spark, sf_dir)
    got = sampling.diverse_views(v, 3, 15.0, 0.0)
    cams = v.withColumnsRenamed({c: f"x_{c}" for c in v.columns if c[:3] in ("pos", "rig", "dow", "fwd")})
    j = got.join(cams, ["scene_id", "view_idx"])
    from vistaloom.functions import geometry as g

    a, b = graph.prefixed(j, "a_", "scene_id"), graph.prefixed(j, "b_", "scene_id")
    pairs = a.join(b, "scene_id").where("a_place < b_place")
    assert pairs.count() and pairs.where(g.rotation_angle(g.camera("a_x_"), g.camera("b_x_")) < 15).count() == 0
    seen = {(r.scene_id, r.view_idx, r.node_id) for r in fx.appearances(spark, sf_dir).collect()}
    for r in sampling.chains(fx.appearances(spark, sf_dir), 3).collect():
        nodes, views = [r.node_0, r.node_1, r.node_2], [r.view_0, r.view_1, r.view_2]
        assert len(set(nodes)) == len(set(views)) == 3
        assert all((r.scene_id, v, n) in seen for v, n in zip(views, nodes)) and all((r.scene_id, v, n) in seen for v, n in zip(views, nodes[1:]))


def test_questions(spark):
    df = spark.createDataFrame([("s", i, "chair", "Left") for i in range(20)], "scene_id string, i int, tag string, answer string")
    q = annotate.questions(df, "mmsi.camera_camera", {"T": F.col("tag"), "A": F.col("answer")}, F.col("i").cast("string"), images=2, quota=5, options=F.array(F.lit("Right"), F.lit("Left")))
    rows = q.collect()
    assert len(rows) == 5
    for r in rows:
        assert r.messages[0]["value"].startswith("<image><image>") and "B. Left" in r.messages[0]["value"] and r.messages[1]["value"] == "B"
    flat = spark.createDataFrame([(["a", "b", "c"], ["i"], [["t"]])], "messages array<string>, QA_images array<string>, question_tags array<array<string>>")
    assert [(r.messages, r.QA_images) for r in annotate.aligned(flat).collect()] == [(["a", "b"], "i")]
    with pytest.raises(PySparkException):
        annotate.marks(spark.createDataFrame([(1, i, "t") for i in range(9)], "g int, i int, tag string"), ["g"], "i").collect()
