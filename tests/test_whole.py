"""Whole texts, whole scenes: against brute force and small cases made by hand."""

import duckdb
import numpy as np
from pyspark.sql import functions as F

from vistaloom.functions import geometry
from vistaloom.operators import graph, kernels, points, sampling, tasks
from vistaloom.plans import fixtures as fx
from vistaloom.plans import scene_queries

def test_texts_are_read_to_their_end(spark, tmp_path):
    far = "word " * 400
    rows = [(3, 1, "user", far + "Answer: 42"), (1, 0, "user", far), (4, 2, "user", far + "A. one")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: (r.human, r.gpt) for r in scene_queries.queries()["messages"](spark, str(tmp_path)).collect()}
    assert got[3] == ("<image>" + far.strip(), "42") and got[1] == (far.strip(), "user Answer: x")
    kinds = {r.conv_id: (r.output_type, r.n) for r in scene_queries.queries()["blink_output_type"](spark, str(tmp_path)).collect()}
    assert kinds[1][1] == len(far + " (B)") and kinds[4][1] == len(far + "A. one (B)")
    spark.createDataFrame([(1, "http://h/" + "x" * 3000)], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    assert scene_queries.queries()["path_resolve"](spark, str(tmp_path)).first().full == "/data/root/" + "x" * 3000


def test_the_only_chain_of_a_scene_is_found(spark):
    rows = [(s, v, n) for s in range(5) for v, n in [("v0", "A"), ("v0", "B"), ("W", "B"), ("W", "C"), ("Z", "C"), *[(f"b{i}", "B") for i in range(1000)]]]
    seen = spark.createDataFrame(rows, "scene_id int, view_idx string, node_id string")
    got = sampling.chains(seen.where("view_idx <> 'Z'"), 3).collect() + sampling.chains(seen.where("node_id <> 'C'"), 3).collect()
    assert got == []
    got = sampling.chains(seen, 3).orderBy("scene_id").collect()
    assert [tuple(r) for r in got] == [(s, "A", "v0", "B", "W", "C", "Z") for s in range(5)]


def test_views_of_a_chain_differ_in_pose(spark, sf_dir):
    v, seen = fx.views(spark, sf_dir), fx.appearances(spark, sf_dir)
    at = {(r.scene_id, r.view_idx): [np.array([r[f"{a}_{c}"] for c in "xyz"]) for a in ("right", "down", "fwd")] for r in v.collect()}
    got = sampling.chains(seen, 3, views=v, min_rotation=60.0).collect()
    assert got
    for r in got:
        for a, b in ((r.view_0, r.view_1), (r.view_0, r.view_2), (r.view_1, r.view_2)):
            cos = (sum(x @ y for x, y in zip(at[r.scene_id, a], at[r.scene_id, b])) - 1) / 2
            assert np.degrees(np.arccos(np.clip(cos, -1, 1))) >= 60.0
    same = v.select("scene_id", "view_idx", *[F.lit(x).alias(f"{a}_{c}") for a, e in (("pos", (0.0, 0.0, 0.0)), ("right", (1.0, 0.0, 0.0)), ("down", (0.0, 1.0, 0.0)), ("fwd", (0.0, 0.0, 1.0))) for c, x in zip("xyz", e)])
    assert sampling.chains(seen, 3, views=same).count() == 0


def test_camera_object_on_its_bound(spark, tmp_path):
    """Cameras turned by multiples of 15 degrees, objects straight along the world's axes: many bearings are 30."""
    e = [(i, i, 0) for i in range(0, 36000, 15)]
    spark.createDataFrame(e, "event_id long, ts long, user_id long").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(k, "a b c", k % 50) for k in range(0, 40000, 25)], "p_partkey long, p_name string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    for t in ("events", "part"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    v, o, seen = fx.views(spark, str(tmp_path)), fx.objects(spark, str(tmp_path)), fx.appearances(spark, str(tmp_path))
    two = v.where("view_idx < 1").select("scene_id", (F.col("view_idx") + 100000).alias("view_idx"), (F.col("pos_x") + 40).alias("pos_x"), (F.col("pos_y") + 40).alias("pos_y"), F.lit(1.6).alias("pos_z"), *[f"{n}_{k}" for n in ("right", "down", "fwd") for k in "xyz"])
    sql = scene_queries.oracle_sql()["camera_object_self"]
    head = sql[: sql.index("SELECT p.scene_id")]
    want = con.execute(f"{head} SELECT view_idx, node_id FROM u WHERE view_idx < 300 ORDER BY 1, 2").fetchall()
    near = v.drop("event_id", "n").where("view_idx < 300")
    target = tasks.camera_object(near.unionByName(two), o, seen, "self", gates=tasks.PAIR | {"max_vertical": None}).where("b_view_idx = 100000")
    got = sorted((r.a_view_idx, r.node_id) for r in target.collect())
    assert len(want) > 10_000 and got == want


def test_all_views_of_a_long_scene_are_paired(spark):
    v = spark.range(401).select(F.lit(1).alias("scene_id"), F.col("id").alias("view_idx"))
    assert graph.view_pairs(v).count() == 401 * 400 // 2


def test_scans_count_by_input_not_by_file(spark, tmp_path):
    """An input of many files is one part; an empty one is a part too, as in the SQL."""
    spark.range(10).withColumnRenamed("id", "doc_id").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(0).withColumnRenamed("id", "doc_id").write.parquet(f"{tmp_path}/labels.parquet")
    got = sorted(map(tuple, scene_queries.queries()["parquet_scan"](spark, str(tmp_path)).collect()))
    assert got == [("documents.parquet", 10, 45), ("labels.parquet", 0, None)]


def test_near_points_of_two_keys_are_counted(spark, monkeypatch):
    """Against all pairs, with repeated and lost points, in one block and in several, and with short lists."""
    rng = np.random.default_rng(5)
    p = np.round(rng.uniform(-0.2, 0.2, (400, 3)), 2) + rng.integers(0, 2, (400, 1)) * 50.0
    key = rng.integers(0, 23, 400)
    rows = [(int(k), *map(float, x)) for k, x in zip(key, p)]
    lost = [(1, None, 0.0, 0.0), (2, float("nan"), 0.0, 0.0), (3, float("inf"), 0.0, 0.0), (4, float("inf"), 0.0, 0.0), (None, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows + rows[:50] + lost, "k long, p_x double, p_y double, p_z double")
    want: dict = {}
    once = sorted(set(rows))
    for a in once:
        for b in once:
            if a[0] < b[0] and round(float(np.sqrt(sum((u - v) * (u - v) for u, v in zip(a[1:], b[1:])))), 9) <= 0.05:
                want[a[0], b[0]] = want.get((a[0], b[0]), 0) + 1
    assert len(want) > 100
    for block in (2_000_000, 100, 20):
        got = points.range_counts(df, "k", 0.05, block)
        assert {(r.a_key, r.b_key): r.n for r in got.collect()} == want and got.count() == len(want)
    x = np.array([r[1:] for r in once])
    names, owner = np.unique([r[0] for r in once], return_inverse=True)
    for at_once, listed in ((7, 10_000), (2_000_000, 1), (1, 1), (50, 300)):
        monkeypatch.setattr(points, "AT_ONCE", at_once)
        monkeypatch.setattr(points, "LISTED", listed)
        got = {(int(names[o]), int(names[b])): int(n) for o, others, count in points.near_counts(x, owner, x, owner)(0.05) for b, n in zip(others, count) if b > o}
        assert got == want


def test_crowded_cells_are_counted_whole(spark):
    """2,000 places of one cell in each of 60 keys: seven billion pairs of points, which no join lists in time."""
    p = spark.range(120_000).select((F.col("id") % 60).alias("k"), *[(F.floor(F.col("id") / 60 / d) % 13 / 1000.0).alias(f"p_{c}") for c, d in zip("xyz", (1, 13, 169))])
    n = points.range_counts(p, "k", 0.05).groupBy("n").count().collect()
    assert [tuple(r) for r in n] == [(2_000**2, 60 * 59 // 2)]


def test_object_positions_shuffle_no_pairs(spark, sf_dir):
    """Only views and objects are dealt by scene; pairs of views and their objects never are."""
    plan = scene_queries.queries()["object_position"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join " in x]
    assert joins and not any("a_view_idx" in x or "anchor" in x for x in joins)


def test_far_footprints_are_left_out_before_the_kernel(spark):
    """The same pairs as the kernel finds among all of them."""
    rng = np.random.default_rng(3)
    rows = [(1, n, *map(float, rng.uniform(-4, 4, 2)), 0.0, *map(float, rng.uniform(0.1, 2, 3)), *map(float, rng.uniform(-3, 3, 3))) for n in range(60)]
    cols = [f"{a}_{c}" for a in "cl" for c in "xyz"] + ["e0", "e1", "e2"]
    o = spark.createDataFrame(rows, "scene_id int, node_id int, " + ", ".join(f"{c} double" for c in cols))
    ends = geometry.corners(geometry.vec("c"), geometry.vec("l"), geometry.box_axes())
    flat = {r.node_id: kernels.hull_2d(np.array(r.ring).reshape(8, 2)) for r in o.select("*", *geometry.trig()).select("node_id", F.array(*[x for p in ends for x in (p.x, p.y)]).alias("ring")).collect()}
    for slack in (0.0, 0.5, 4.0):
        want = {(a, b) for a in flat for b in flat if a < b and kernels.footprints_overlap(flat[a], flat[b], slack)}
        assert want and {(r.a_node_id, r.b_node_id) for r in kernels.footprint_overlaps(o, slack).collect()} == want


def test_tiled_pairs_are_whole_and_written_small(spark, tmp_path):
    rows = spark.range(6000).select((F.col("id") % 2).alias("k"), F.col("id").alias("at"), (F.xxhash64("id") % 100_000 / 1e4).alias("d"))
    few = rows.where("at < 700")
    got = {tuple(r) for r in graph.tiled_pairs(few, "k", "at", "d", tile=50, spread=3).collect()}
    one = [tuple(r) for r in few.collect()]
    assert got == {(a[0], a[1], a[2], b[1], b[2]) for a in one for b in one if a[0] == b[0] and a[1] < b[1]} and len(got) == 2 * 350 * 349 // 2
    p = graph.tiled_pairs(rows, "k", "at", "d")
    p.write.parquet(f"{tmp_path}/pairs")
    n = 2 * 3000 * 2999 // 2
    assert spark.read.parquet(f"{tmp_path}/pairs").count() == n
    assert sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet")) < 0.6 * n  # a plain join writes over 3 bytes a pair


def rows_made(df, kind):
    """Rows that plan nodes of a kind made in the last stage of df's last action."""
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        n += p.longMetric("numOutputRows").value() if name == kind else 0
        below = p.children()
        todo += [p.executedPlan()] if name == "AdaptiveSparkPlanExec" else [p.plan()] if name == "ResultQueryStageExec" else [below.apply(i) for i in range(below.size())]
    return n


def test_pairs_are_passed_on_a_tile_at_a_time(spark):
    """Generated code holds what a streamed row yields: pairs of a tile with all its rows a fill the memory of large inputs."""
    rows = spark.range(6000).select((F.col("id") % 2).alias("k"), F.col("id").alias("at"), F.rand(1).alias("d"))
    p = graph.tiled_pairs(rows, "k", "at", "d").limit(1)
    assert len(p.collect()) == 1
    assert 0 < rows_made(p, "GenerateExec") <= 4 * 512  # some tasks are asked at once; all pairs are 9 million
