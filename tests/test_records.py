"""Question records, kernels and files against brute force and small cases made by hand."""

import itertools
import pickle
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vistaloom.functions import templates
from vistaloom.operators import annotate, kernels, points, records, sampling, tables, tasks
from vistaloom.plans import fixtures as fx
from vistaloom.plans import scene_queries as sq
from vistaloom.sources import png, readers, sinks


def depths(spark):
    rows = [(f, f"o{i}", float((i * 7 + f * 3) % 11) / 2) for f in range(40) for i in range(2 + f % 6)]
    return spark.createDataFrame(rows, "frame int, name string, depth double"), rows


@pytest.mark.parametrize("mcq", [False, True])
@pytest.mark.parametrize("kind", ["ordering", "choice"])
def test_depth_questions(spark, kind, mcq):
    df, rows = depths(spark)
    got = records.depth_questions(df, kind, mcq, ["frame"]).collect()
    least = 4 if mcq and kind == "choice" else 3
    sizes = {f: len([r for r in rows if r[0] == f]) for f in range(40)}
    assert {r.frame for r in got} == {f for f, n in sizes.items() if n >= least}
    depth = {(f, n): d for f, n, d in rows}
    kinds = set()
    for r in got:
        assert r.ordered == sorted(r.ordered, key=lambda n: (depth[r.frame, n], n)) and sorted(r.asked) == sorted(r.ordered) and len(r.ordered) == min(4, sizes[r.frame])
        kinds.add(r.kind)
        answer = r.options["ABCD".index(r.answer)] if mcq else r.answer
        if kind == "ordering":
            assert answer == ", ".join(r.ordered) and (not mcq or len(set(r.options)) == 4 == len([o for o in r.options if sorted(o.split(", ")) == sorted(r.ordered)]))
        else:
            asked = {"farthest": r.ordered[-1], "closest": r.ordered[0]}
            at = next(i for i, o in enumerate(records.ORDINALS) if f" {o} " in r.prompt) if r.kind == "choice" else None
            assert answer == (r.ordered[at] if r.kind == "choice" else asked[r.kind]) and (not mcq or set(r.options) == set(r.ordered))
        assert "[" not in r.prompt and r.messages[1]["value"].endswith(r.answer) and all(n in r.messages[0]["value"] for n in r.ordered)
    assert kinds == ({"ordering"} if kind == "ordering" else {"farthest", "closest", "choice"})


def scene(spark, sf_dir):
    o = fx.objects(spark, sf_dir)
    return o, {(r.scene_id, r.node_id): r for r in o.collect()}


def volume(r):
    return round(abs(r.l_x * r.l_y * r.l_z), 9)


def test_chains(spark, sf_dir):
    o, nodes = scene(spark, sf_dir)
    two, three = ([r for r in sampling.chains(fx.appearances(spark, sf_dir), n, views=fx.views(spark, sf_dir)).collect()] for n in (2, 3))
    cloud = {}
    for r in sq._node_clouds(o).collect():
        cloud.setdefault((r.scene_id, r.node_id), []).append((r.p_x, r.p_y, r.p_z))
    near = lambda s, a, b: min(float(np.linalg.norm(np.subtract(p, q))) for p in cloud[s, a] for q in cloud[s, b])
    ends = {r.scene_id: (r.node_0, r.node_1) for r in two}
    got = sq.queries()["multiview_distance_pair"](spark, sf_dir).collect()
    assert {r.scene_id: (r.node_a, r.node_b) for r in got} == ends
    for r in got:
        d = near(r.scene_id, r.node_a, r.node_b)
        assert r.distance == pytest.approx(d, abs=1e-6) and r.answer == f"{d * (100 if r.unit == 'cm' else 1):.2f} {r.unit}"
    assert {r.unit for r in got} == {"m", "cm"}
    members = {r.scene_id: {r.node_0, r.node_1, r.node_2} for r in three}
    got = sq.queries()["multiview_distance_multi"](spark, sf_dir).collect()
    assert {r.scene_id for r in got} == set(members)
    for r in got:
        d = {n: round(near(r.scene_id, r.node_ref, n), 6) for n in members[r.scene_id] - {r.node_ref}}
        best = min(d.values()) if r.kind == "closest" else max(d.values())
        assert r.node_answer == min(n for n, x in d.items() if x == pytest.approx(best, abs=1e-9)) and r.answer == nodes[r.scene_id, r.node_answer].tag.lower()
    for r in sq.queries()["multiview_size_pair"](spark, sf_dir).collect():
        bigger = volume(nodes[r.scene_id, r.node_a]) > volume(nodes[r.scene_id, r.node_b])
        assert (r.answer == "Yes") == (bigger if r.kind == "big" else not bigger)
    for r in sq.queries()["multiview_size_multi"](spark, sf_dir).collect():
        v = sorted(((volume(nodes[r.scene_id, n]), n) for n in members[r.scene_id]))
        most = [n for x, n in v if x == (v[-1][0] if r.kind == "biggest" else v[0][0])]
        assert r.node_answer == min(most)


def test_object_positions(spark):
    at = {1: (0.0, 0.0, "desk"), 2: (0.0, 5.0, "lamp"), 3: (5.0, 0.0, "bed"), 4: (0.1, 0.0, "mat"), 5: (9.0, 9.0, "bed")}
    o = spark.createDataFrame([(1, n, t, x, y, 0.5, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0) for n, (x, y, t) in at.items()], "scene_id int, node_id int, tag string, c_x double, c_y double, c_z double, l_x double, l_y double, l_z double, e0 double, e1 double, e2 double")
    v = spark.createDataFrame([(1, 0), (1, 1)], "scene_id int, view_idx int")
    seen = spark.createDataFrame([(1, 0, n) for n in (1, 2)] + [(1, 1, n) for n in (1, 3, 4)], "scene_id int, view_idx int, node_id int")
    got = [tuple(r) for r in records.object_positions(v, o, seen).select("anchor", "node_a", "node_b", "answer").collect()]
    assert got == [(1, 2, 3, "east")]  # the mat lies on the desk
    assert sorted(tuple(r)[1:] for r in kernels.footprint_overlaps(o).collect()) == [(1, 4)]
    both = seen.unionByName(spark.createDataFrame([(1, 0, 5)], "scene_id int, view_idx int, node_id int"))
    assert records.object_positions(v, o, both).count() == 0  # a bed is in both views


def test_correspondence_questions(spark):
    rows = [(k, 12 + i, 15, 20 + (k + i) % 20, 12 + k % 20, 0.001) for k in range(60) for i in range(3)]
    m = spark.createDataFrame(rows, "k int, u long, v long, u2 long, v2 long, distance double")
    for mcq in (False, True):
        got = records.correspondence_questions(m, ["k"], mcq).collect()
        assert len(got) > 50
        for r in got:
            match = next(x for x in rows if x[:3] == (r.k, r.u, r.v))
            pts = [(p.u, p.v) for p in r.points]
            assert pts[r.labels.index(r.right)] == match[3:5] and len(set(pts)) == 4
            assert all((u - match[3]) ** 2 + (v - match[4]) ** 2 >= 64 and 10 <= u < 54 and 10 <= v < 38 for u, v in pts if (u, v) != match[3:5])
            human, gpt = (x["value"] for x in r.messages)
            assert gpt == r.answer and ("Options:" in human) == mcq
            assert r.answer == (f"{'ABCD'[r.labels.index(r.right)]} point-{r.right}" if mcq else r.answer) and r.answer.endswith(r.right)
        assert {tuple(r.labels) for r in got} == {tuple("1234"), tuple("ABCD")}


def test_correspondences_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    a = [(0, int(u), int(v), *map(float, p)) for u, v, p in zip(rng.integers(0, 64, 200), rng.integers(0, 48, 200), rng.random((200, 3)))]
    b = [(0, int(u), int(v), *map(float, p)) for u, v, p in zip(rng.integers(0, 64, 200), rng.integers(0, 48, 200), rng.random((200, 3)))]
    schema = "k int, u int, v int, p_x double, p_y double, p_z double"
    got = {(r.u, r.v): (r.u2, r.v2) for r in annotate.correspondences(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["k"], 0.1, 5, (64, 48), 1).collect()}
    inside = lambda r: 5 <= r[1] <= 58 and 5 <= r[2] <= 42
    want = {}
    for x in filter(inside, a):
        for y in filter(inside, b):
            d = float(np.linalg.norm(np.subtract(x[3:], y[3:])))
            if d <= 0.1:
                want[x[1:3]] = min(want.get(x[1:3], (9.0, 0, 0)), (d, *y[1:3]))
    assert got == {k: x[1:] for k, x in want.items()} and len(got) > 20


def test_pose_questions(spark, sf_dir):
    got = records.pose_questions(*sq._scene(spark, sf_dir)).collect()
    assert got and all(len(r.views) == 3 and len(r.maps) == 4 and r.answer in "ABCD" for r in got)
    pos = {(r.scene_id, r.view_idx): (r.pos_x, r.pos_y) for r in fx.views(spark, sf_dir).collect()}
    for r in got:
        true = {e.entity_id: (e.x, e.y) for e in r.maps["ABCD".index(r.answer)] if e.kind == "camera"}
        assert true == {v: pytest.approx(pos[r.scene_id, v], abs=1e-6) for v in r.views}
        assert all({(e.entity_id, e.x, e.y) for e in m if e.kind == "object"} == {(e.entity_id, e.x, e.y) for e in r.maps[0] if e.kind == "object"} for m in r.maps)


def test_every_template_can_be_filled():
    assert len(templates.TEMPLATES) == 49
    assert all(q and a for q, a in templates.TEMPLATES.values())


# Kernels.


def test_union_area():
    rng = np.random.default_rng(1)
    for _ in range(20):
        shapes = [kernels.hull_2d(rng.random((6, 2)) * 0.6 + rng.random(2) * 0.4) for _ in range(4)]
        grid = (np.stack(np.meshgrid(np.arange(400), np.arange(400)), axis=-1).reshape(-1, 2) + 0.5) / 400
        hit = np.zeros(len(grid), bool)
        for s in shapes:
            t = np.roll(s, -1, axis=0)
            hit |= np.logical_and.reduce([(b - a)[0] * (grid - a)[:, 1] - (b - a)[1] * (grid - a)[:, 0] >= 0 for a, b in zip(s, t)])
        assert kernels.union_area(shapes) == pytest.approx(hit.mean(), abs=0.01)
    square = np.array([[0, 0], [1, 0], [1, 1], [0, 1.0]])
    assert kernels.union_area([square, square]) == pytest.approx(1) and kernels.union_area([square, square + [2, 0]]) == pytest.approx(2) and kernels.union_area([]) == 0


def test_faces_behind_the_camera_do_not_count():
    box = np.array([[x, y, z] for x in (-1.0, 1.0) for y in (-1.0, 1.0) for z in (-1.0, 3.0)])
    assert len(kernels.box_faces(box, 50, 50, 32, 24)) == 1  # the far face alone
    assert len(kernels.box_faces(box + [0, 0, 5], 50, 50, 32, 24)) == 1  # all: one outline
    assert kernels.shown_share(kernels.box_faces(box - [0, 0, 9], 50, 50, 32, 24), 64, 48) == 0


@pytest.mark.parametrize("n, m", [(1, 1), (5, 700), (900, 1100)])
def test_nearest_of_clouds(n, m):
    rng = np.random.default_rng(n)
    a, b = rng.random((n, 3)), rng.random((m, 3)) + [1.1, 0, 0]
    assert points.nearest_of_clouds(a, b) == pytest.approx(np.sqrt(((a[:, None] - b) ** 2).sum(-1)).min())


def test_neighbour_means():
    p = np.concatenate([np.random.default_rng(4).random((1500, 3)), np.zeros((3, 3))])
    d = np.sqrt(((p[:, None] - p) ** 2).sum(-1))
    for k in (1, 10, 5000):
        assert points.neighbour_means(p, k) == pytest.approx(np.sort(d, axis=1)[:, : min(k, len(p))].mean(axis=1))


@pytest.mark.parametrize("joined", [0, 10**9])
def test_nearest_distance_both_ways(spark, joined):
    rng = np.random.default_rng(8)
    rows = [(k, s, *map(float, p)) for k in range(4) for s in "ab" for p in rng.random((30 + k, 3))]
    df = spark.createDataFrame(rows, "k int, s string, p_x double, p_y double, p_z double")
    got = {r.k: r.distance for r in points.nearest_distance(df.where("s = 'a'"), df.where("s = 'b' and k < 3"), ["k"], joined).collect()}
    cloud = lambda k, s: np.array([r[2:] for r in rows if r[:2] == (k, s)])
    assert got == {k: pytest.approx(np.sqrt(((cloud(k, "a")[:, None] - cloud(k, "b")) ** 2).sum(-1)).min()) for k in range(3)}


def test_box_filter(spark):
    axes = {"right_x": 1.0, "right_y": 0.0, "right_z": 0.0, "down_x": 0.0, "down_y": 1.0, "down_z": 0.0, "fwd_x": 0.0, "fwd_y": 0.0, "fwd_z": 1.0, "pos_x": 0.0, "pos_y": 0.0, "pos_z": 0.0}
    boxes = [[0.0, 0.0, 2.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0], [0.0, 0.0, -3.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0], [9.0, 0.0, 2.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0], [0.0, 0.0, 2.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0], [0.5, 0.0, 30.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0]]
    row = (7, *axes.values(), 50.0, 50.0, 32.0, 24.0, ["desk", "behind", "beside", "wall", "no points"], boxes, [1, 2, 3, 4, 5])
    frames = spark.createDataFrame([row, (8, *row[1:])], "frame_id int, " + ", ".join(f"{a} double" for a in axes) + ", fx double, fy double, cx double, cy double, obj_tags array<string>, bboxes_3d_world_coords array<array<double>>, ids array<int>")
    px = [(7, u, v, 1.7 + 0.02 * ((u * 7 + v * 3) % 30)) for u in range(20, 45) for v in range(12, 37)]
    out = kernels.filtered_boxes(frames, spark.createDataFrame(px, "frame_id int, u int, v int, d double"), ("wall",), ["ids"]).collect()
    assert [(r.frame_id, r.obj_tags, r.ids, r.bboxes_3d_world_coords) for r in out] == [(7, ["desk"], [1], [boxes[0]])]
    want = {(v, u) for _, u, v, d in px if abs((u - 32) * d / 50) <= 0.45 and abs((v - 24) * d / 50) <= 0.45 and abs(d - 2) <= 0.45}
    assert {(m.v, m.u) for m in out[0].masks[0]} == want


def test_fused_clouds(spark):
    v = spark.createDataFrame([(i, 0.1 * i, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 50.0, 50.0, 32.0, 24.0) for i in range(3)], "view_idx int, pos_x double, pos_y double, pos_z double, right_x double, right_y double, right_z double, down_x double, down_y double, down_z double, fwd_x double, fwd_y double, fwd_z double, fx double, fy double, cx double, cy double")
    px = [(o, w, u, u, 1.0) for o, views in ((1, (0, 1)), (2, (2,))) for w in views for u in range(20, 40)] + [(1, 0, 30, 30, 50.0), (1, 0, 31, 30, 0.0)]
    got = points.fused_clouds(spark.createDataFrame(px, "obj int, view_idx int, u int, v int, d double"), v, ["obj"], neighbours=5).collect()
    assert {r.obj for r in got} == {1} and 38 <= len(got) <= 40 and all(r.p_z == 1.0 for r in got)


@pytest.mark.parametrize("size", [(64, 48, 100, 30), (10, 10, 10, 10), (7, 5, 3, 11)])
def test_mask_resize(spark, size):
    w, h, tw, th = size
    mask = np.random.default_rng(5).random((h, w)) < 0.4
    px = [(1, int(u), int(v)) for v, u in zip(*np.nonzero(mask))]
    got = {(r.u, r.v) for r in points.resized(spark.createDataFrame(px, "o int, u long, v long"), w, h, tw, th).collect()}
    assert got == {(u, v) for u, v in itertools.product(range(tw), range(th)) if mask[int((v + 0.5) * h / th), int((u + 0.5) * w / tw)]}


# Files.


@pytest.mark.parametrize("shape, kind", [((6, 8), np.uint8), ((5, 7, 3), np.uint8), ((4, 9), np.uint16), ((3, 3, 4), np.uint16), ((2, 5, 2), np.uint8)])
def test_png(shape, kind):
    a = np.random.default_rng(2).integers(0, np.iinfo(kind).max, shape).astype(kind)
    assert (png.decode(png.encode(a)).reshape(shape) == a).all()


def test_png_filters():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 256, (5, 6, 3)).astype(np.int64)
    lines, up = [], np.zeros((6, 3), np.int64)
    for way, row in enumerate(a):
        left, corner = np.vstack([np.zeros((1, 3), np.int64), row[:-1]]), np.vstack([np.zeros((1, 3), np.int64), up[:-1]])
        p = left + up - corner
        near = [np.abs(p - x) for x in (left, up, corner)]
        likely = np.where((near[0] <= near[1]) & (near[0] <= near[2]), left, np.where(near[1] <= near[2], up, corner))
        guess = [0, left, up, (left + up) // 2, likely][way]
        lines.append(bytes([way]) + ((row - guess) % 256).astype(np.uint8).tobytes())
        up = row
    chunk = lambda n, d: struct.pack(">I", len(d)) + n + d + struct.pack(">I", zlib.crc32(n + d))
    data = png.SIGN + chunk(b"IHDR", struct.pack(">IIBBBBB", 6, 5, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")
    assert (png.decode(data) == a).all()
    with pytest.raises(ValueError):
        png.decode(b"GIF89a")


def test_pictures_and_depth(spark, tmp_path):
    (tmp_path / "d.png").write_bytes(png.encode(np.array([[1000, 2000], [0, 4000]], np.uint16)))
    (tmp_path / "g.png").write_bytes(png.encode(np.array([[5, 6]], np.uint8)))
    files = spark.read.format("binaryFile").load(str(tmp_path / "d.png")).withColumn("depth_scale", F.lit(1000))
    assert sorted((r.u, r.v, r.d) for r in readers.depth_pixels(files).collect()) == [(0, 0, 1.0), (0, 1, 0.0), (1, 0, 2.0), (1, 1, 4.0)]
    r = readers.rgb_images(spark.read.format("binaryFile").load(str(tmp_path / "g.png"))).first()
    assert (r.width, r.height, bytes(r.rgb)) == (2, 1, bytes([5, 5, 5, 6, 6, 6]))


def test_annotations_and_csv(spark, tmp_path):
    cam = np.arange(9.0).reshape(3, 3)
    data = {"data_list": [{"sample_idx": "s1", "images": [{"img_path": "a.jpg", "cam2img": cam}, {"img_path": "a.jpg", "cam2img": cam}]}, {"sample_idx": "s2", "cam2img": np.eye(4), "images": [{"img_path": "b.jpg"}]}]}
    (tmp_path / "a.pkl").write_bytes(pickle.dumps(data))
    got = readers.annotations(spark.read.format("binaryFile").load(str(tmp_path / "a.pkl"))).orderBy("place").collect()
    assert [(r.sample_idx, r.img_path) for r in got] == [("s1", "a.jpg"), ("s2", "b.jpg")]
    assert got[0].cam2img[:3] == [0.0, 1.0, 2.0] and got[0].cam2img[15] == 1.0 and got[1].cam2img == np.eye(4).ravel().tolist()
    (tmp_path / "bad.pkl").write_bytes(pickle.dumps(print))
    with pytest.raises(Exception, match="refused"):
        readers.annotations(spark.read.format("binaryFile").load(str(tmp_path / "bad.pkl"))).collect()
    (tmp_path / "m.csv").write_text("scene,w\ns1,640\ns1,9\ns2,320\n")
    assert sorted(tuple(r) for r in readers.csv_rows(spark, str(tmp_path / "m.csv"), "scene").collect()) == [("s1", "640"), ("s2", "320")]


def test_scene_frames(spark):
    t = lambda rows: spark.createDataFrame(rows, "scene_id string, frame_name string, path string")
    rgb, depth, pose = (t([("s", n, f"{k}/{n}") for n in names]) for k, names in (("rgb", "abc"), ("depth", "ab"), ("pose", "bc")))
    k = spark.createDataFrame([("s", "k/s")], "scene_id string, path string")
    assert [tuple(r) for r in readers.scene_frames(rgb, depth, pose, k).collect()] == [("s", "b", "rgb/b", "depth/b", "pose/b", "k/s")]


def test_scene_coherent_files(spark, tmp_path):
    df = spark.createDataFrame([(s, i) for s in range(20) for i in range(s)], "scene_id int, i int")
    sinks.write_by_scene(df, f"{tmp_path}/a", rows_each=30)
    files = spark.read.parquet(f"{tmp_path}/a").select("scene_id", F.col("_metadata.file_name").alias("f"))
    assert files.count() == df.count() and files.groupBy("scene_id").agg(F.countDistinct("f").alias("n")).where("n > 1").count() == 0
    sizes = [r.n for r in files.groupBy("f").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 30 + 19 and len(sizes) >= 190 // 49
    sinks.write_by_scene(df, f"{tmp_path}/b", 3)
    assert spark.read.parquet(f"{tmp_path}/b").count() == df.count()


def test_converted_questions(spark, tmp_path):
    turn = "array<struct<`from`:string,value:string>>"
    qa = lambda n, q: spark.createDataFrame([([("human", f"<image>{q} {i}"), ("gpt", "x")], [f"t{i}"]) for i in range(n)], f"messages {turn}, question_tags array<string>").coalesce(1)

    def put(df, folder, name):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        df.write.mode("overwrite").parquet(f"{tmp_path}/w")
        next((tmp_path / "w").glob("*.parquet")).rename(tmp_path / folder / name)

    put(qa(3, "How many?"), "r/base_pipeline_demo_x/annotation_stage/mmsi_motion", "data.parquet")
    put(qa(2, "A. one"), "r/base_pipeline_demo_size", "data_part_0.parquet")
    put(qa(2, "A. two"), "r/base_pipeline_demo_size", "data_part_1.parquet")
    put(qa(1, "z"), "r/other", "ignored.parquet")
    got = sinks.converted(spark, str(tmp_path / "r"))
    assert sorted(got) == ["mmsi_motion", "size"]
    rows = got["size"].orderBy("id").collect()
    assert [r.id for r in rows] == [f"size_{i:08d}" for i in range(4)] and [r.conversations[0]["value"] for r in rows] == ["A. one 0", "A. one 1", "A. two 0", "A. two 1"]
    assert {(r.input_type, r.output_type) for r in rows} == {("singleview", "MCQ")}
    merged = sinks.converted(spark, str(tmp_path / "r"), merge=True)["all"]
    assert merged.count() == 7 and merged.select("id").distinct().count() == 7


def test_written_images_lines_and_json(spark, tmp_path):
    df = spark.createDataFrame([([("a/x.png", b"12"), ("b.png", b"345")],)], "images array<struct<name:string,bytes:binary>>")
    assert sorted(tuple(r) for r in sinks.write_images(df, "out", str(tmp_path)).collect()) == [("a/x.png", 2), ("b.png", 3)]
    assert (tmp_path / "out/a/x.png").read_bytes() == b"12" and len(list((tmp_path / "out").rglob("*.png"))) == 2 == len([p for p in (tmp_path / "out").rglob("*") if p.is_file()])
    for i in range(2):
        sinks.append_json(spark.createDataFrame([(i,)], "n int"), f"{tmp_path}/j")
    assert sorted(r.n for r in spark.read.json(f"{tmp_path}/j").collect()) == [0, 1]
    assert sinks.point_lines(spark.createDataFrame([(1.0, 2.5, -3.0)], "p_x double, p_y double, p_z double")).first().value == "v 1.000000 2.500000 -3.000000"


def test_views_are_thinned_before_they_are_paired(spark):
    from vistaloom.operators import graph

    v = spark.createDataFrame([(1, i) for i in range(50)] + [(2, i) for i in range(4)], "scene_id int, view_idx int")
    n = {r.scene_id: r["count"] for r in graph.view_pairs(v, most=10).groupBy("scene_id").count().collect()}
    assert n == {1: 45, 2: 6} and graph.view_pairs(v).count() == 50 * 49 // 2 + 6


def test_quotas_come_before_the_third_node(spark, sf_dir):
    o = fx.objects(spark, sf_dir)
    whole = {tuple(r) for r in tasks.relative_distance(o).select("scene_id", "node_a", "node_b", "node_c", "answer").collect()}
    some = tasks.relative_distance(o, quota=5).select("scene_id", "node_a", "node_b", "node_c", "answer").collect()
    assert {tuple(r) for r in some} < whole and max(len({(r.node_a, r.node_b) for r in some if r.scene_id == s}) for s in range(15)) <= 5
    assert tasks.compass_relation(o, quota=2).count() < tasks.compass_relation(o).count()
    assert tables.limited(o, "scene_id", 2).select("scene_id").distinct().count() == 2


PLAN = """
pipeline:
  file_name: demo
  stages:
    flatten_stage:
      - {method: flatten, output_dir: a, anchor: obj_tags, columns: [ids]}
    group_stage:
      - {method: group, output_dir: b, key: scene_id, lists: [obj_tags, ids], order: n, depends_on: flatten_stage/flatten}
"""


def test_plans_from_the_command_line(spark, tmp_path, capsys):
    from vistaloom.plans import cli

    for name in "xy":
        spark.createDataFrame([(f"{name}{s}", s, ["a", "b"], [1, 2]) for s in range(4)], "scene_id string, n int, obj_tags array<string>, ids array<int>").write.parquet(f"{tmp_path}/{name}")
    out = cli.run(spark, PLAN, [f"{tmp_path}/x", f"{tmp_path}/y"], f"{tmp_path}/out")
    assert sorted(out) == [f"part_{i}/{t}" for i in (1, 2) for t in ("flatten_stage/flatten", "group_stage/group")]
    assert out["part_1/flatten_stage/flatten"].count() == 8 and out["part_2/group_stage/group"].count() == 4
    made = (tmp_path / "out/demo/part_1/group_stage/group/_SUCCESS").stat().st_mtime
    cli.run(spark, PLAN, [f"{tmp_path}/x", f"{tmp_path}/y"], f"{tmp_path}/out")
    assert (tmp_path / "out/demo/part_1/group_stage/group/_SUCCESS").stat().st_mtime == made
    (tmp_path / "p.yaml").write_text(PLAN)
    cli.main(["--config", f"{tmp_path}/p.yaml", "--input", f"{tmp_path}/x", "--output", f"{tmp_path}/few", "--max-scenes", "2"])
    assert "flatten_stage/flatten: 4 rows" in capsys.readouterr().out
    with pytest.raises(ValueError):
        cli.run(spark, PLAN, [f"{tmp_path}/x"], f"{tmp_path}/bad", methods={})


def test_record_checks(spark):
    df = spark.createDataFrame([(1, "i", ["a"]), (2, None, ["a"]), (3, "i", []), (4, "i", None)], "id int, image string, obj_tags array<string>")
    assert [r.id for r in tables.single_checked(df).collect()] == [1] and tables.single_checked(df.drop("image")).count() == 0
    two = spark.createDataFrame([(1, ["a"], [1]), (2, ["a"], [1, 2]), (3, [], []), (4, None, [1])], "id int, x array<string>, y array<int>")
    assert [r.id for r in tables.multi_checked(two, ["x", "y"]).collect()] == [1] and tables.multi_checked(two).count() == 0


def test_captions(spark):
    df = records.caption_requests(spark.range(2000).withColumnRenamed("id", "key"), "key")
    rows = df.collect()
    share = lambda name: np.mean([any(t in r.request for t in records.CAPTION[name]) for r in rows])
    assert all(share(n) == pytest.approx(1 - p, abs=0.05) for n, p in records.LEFT_OUT.items())
    got = records.caption_answers(df.withColumn("caption", F.when(F.col("key") == 7, "A room."))).collect()
    assert len(got) == 1 and got[0].messages[1]["value"] == "A room." and got[0].messages[0]["value"].startswith("<image>")


def test_snapshots_and_image_bytes(spark, tmp_path):
    assert readers.snapshot("owner/set-1", "/data") == "/data/owner/set-1/train*.parquet" and readers.snapshot("/a/b", "/data") == "/a/b"
    rgb = spark.createDataFrame([("p", 2, 1, bytearray(range(6)))], "path string, width int, height int, rgb binary")
    image = readers.png_images(rgb).first().image["bytes"]
    assert png.decode(bytes(image)).ravel().tolist() == list(range(6))


def test_detections(spark):
    from vistaloom.operators import detections

    boxes = [(1, 0, "t", 0.9, 0.9, 0.9, 0, 0, 10, 10), (1, 1, "t", 0.9, 0.9, 0.9, 0, 0, 9, 9), (1, 2, "u", 0.9, 0.9, 0.9, 20, 20, 30, 30), (1, 3, "u", 0.9, 0.9, 0.9, 20, 50, 30, 60), (1, 4, "v", 0.2, 0.9, 0.9, 0, 0, 5, 5), (1, 5, "v", 0.9, None, 0.9, 0, 0, 5, 5), (2, 0, "t", 0.9, 0.9, 0.9, 0, 0, 5, 5)]
    found = spark.createDataFrame(boxes, "frame_id int, obj_idx int, tag string, box_score double, text_score double, mask_score double, x1 int, y1 int, x2 int, y2 int")
    px = [(1, 0, u, 1) for u in range(9)] + [(1, 2, u, 5) for u in range(9)] + [(1, 3, u, 5) for u in range(8)] + [(2, 0, 1, 1)]
    masks = spark.createDataFrame(px, "frame_id int, obj_idx int, u int, v int")
    got = detections.localized(found, masks)
    assert sorted((r.frame_id, r.obj_idx) for r in got.collect()) == [(1, 0), (1, 2)]
    scores = spark.createDataFrame([(1, 0, 0.7), (1, 2, 0.5), (2, 0, 0.9)], "frame_id int, obj_idx int, score double")
    kept = detections.refined(masks, scores, least_pixels=5)
    assert [tuple(r) for r in kept.collect()] == [(1, 0, 0, 1, 8, 1)]
    frames = spark.createDataFrame([(1, ["a", "b", "c"], [7, 8, 9]), (2, ["x"], [1])], "frame_id int, obj_tags array<string>, ids array<int>")
    assert [tuple(r) for r in detections.with_refined(frames, kept, ["obj_tags", "ids"]).collect()] == [(1, ["a"], [7], [[0, 1, 8, 1]])]


def test_drawing(spark):
    from vistaloom.operators import bev, drawing

    image = np.zeros((20, 30, 3), np.uint8)
    drawing.box(image, 5, 5, 15, 12, "red", 1)
    assert (image[5, 5:16] == [255, 0, 0]).all() and (image[12, 5:16] == [255, 0, 0]).all() and not image[6:12, 6:15].any() and not image[:5].any()
    drawing.point(image, 28, 18, "blue", 2)
    assert (image[18, 28] == [0, 0, 255]).all() and (image[18, 26] == [0, 0, 255]).all() and not image[15, 28].any()
    grey, on = np.full((9, 9, 3), 100, np.uint8), np.zeros((9, 9), bool)
    on[2:7, 2:7] = True
    drawing.mask(grey, on, "green")
    assert tuple(grey[4, 4]) == (70, 146, 70) and tuple(grey[2, 4]) == (0, 255, 0) and tuple(grey[0, 0]) == (100, 100, 100)
    df = spark.createDataFrame([("p", 10, 8, bytearray(240), [("box", "red", 1, 1, 8, 6), ("point", "blue", 5, 4, 0, 0)])], "path string, width int, height int, rgb binary, marks array<struct<kind:string,colour:string,x1:int,y1:int,x2:int,y2:int>>")
    out = png.decode(bytes(drawing.marked(df).first().image["bytes"]))
    assert out.shape == (8, 10, 3) and tuple(out[1, 1]) == (255, 0, 0) and tuple(out[4, 5]) == (0, 0, 255)
    e = spark.createDataFrame([(1, "camera", 0, 0.0, 0.0, 0.0, 0.0, 0.0), (1, "object", 5, 9.0, 9.0, 0.0, 0.0, 10.0)], "scene_id int, kind string, entity_id int, x double, y double, half_x double, half_y double, yaw double")
    placed = bev.placed(e, bev.bounds(e))
    picture = png.decode(bytes(drawing.map_pictures(placed).first().image["bytes"]))
    for r in placed.collect():
        assert tuple(picture[r.row * 20 + 10, r.col * 20 + 10]) == drawing.RGB["red" if r.kind == "camera" else "blue"]
    q = spark.createDataFrame([(1, [0]), (1, [9]), (2, [0])], "scene_id int, views array<int>")
    maps = [r.cognitive_map for r in bev.attached(q, placed, views="views").orderBy("scene_id", F.col("views")[0]).collect()]
    assert '"entity_id":0' in maps[0] and '"cameras":[]' in maps[1] and maps[2] is None
    assert bev.attached(q, placed, enable=False).where("cognitive_map is not null").count() == 0


def test_oriented_boxes(spark):
    rng = np.random.default_rng(6)
    a, b, c = 0.4, 0.3, -0.8
    ry, rx, rz = np.array([[np.cos(c), 0, np.sin(c)], [0, 1, 0], [-np.sin(c), 0, np.cos(c)]]), np.array([[1, 0, 0], [0, np.cos(b), -np.sin(b)], [0, np.sin(b), np.cos(b)]]), np.array([[np.cos(a), -np.sin(a), 0], [np.sin(a), np.cos(a), 0], [0, 0, 1]])
    r = ry @ rx @ rz
    half = np.array([3.0, 2.0, 1.0])
    p = (rng.uniform(-1, 1, (4000, 3)) * half) @ r.T + [1, 2, 3]
    got = kernels.oriented_boxes(spark.createDataFrame([(1, *map(float, x)) for x in p], "k int, p_x double, p_y double, p_z double"), ["k"]).first().box
    assert got[:3] == pytest.approx([1, 2, 3], abs=0.2) and got[3:6] == pytest.approx(2 * half, abs=0.4)
    a, b, c = got[6:]
    back = np.array([[np.cos(c) * np.cos(a) + np.sin(c) * np.sin(b) * np.sin(a), -np.cos(c) * np.sin(a) + np.sin(c) * np.sin(b) * np.cos(a), np.sin(c) * np.cos(b)], [np.cos(b) * np.sin(a), np.cos(b) * np.cos(a), -np.sin(b)], [-np.sin(c) * np.cos(a) + np.cos(c) * np.sin(b) * np.sin(a), np.sin(c) * np.sin(a) + np.cos(c) * np.sin(b) * np.cos(a), np.cos(c) * np.cos(b)]])
    assert np.abs((back * r).sum(axis=0)) == pytest.approx([1, 1, 1], abs=0.01)


def test_cloud_files(spark, tmp_path):
    p = spark.createDataFrame([(1, 1.0, 2.0, 3.0), (1, 4.0, 5.0, 6.0), (2, 0.0, 0.0, 0.5)], "k int, p_x double, p_y double, p_z double")
    for suffix, first in ((".pcd", "VERSION .7"), (".ply", "ply")):
        assert sinks.write_images(sinks.cloud_files(p, ["k"], suffix), "c", str(tmp_path)).count() == 2
        lines = (tmp_path / f"c/1{suffix}").read_text().splitlines()
        assert lines[0] == first and sorted(lines[-2:]) == ["1.000000 2.000000 3.000000", "4.000000 5.000000 6.000000"]
