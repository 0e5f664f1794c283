"""Kernels, sources, sinks, plans from YAML, and streams."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vistaloom.functions import templates
from vistaloom.operators import kernels
from vistaloom.operators.tables import numbered
from vistaloom.plans.config import Plan, parts, quotas
from vistaloom.sources import readers, sinks
from vistaloom.streaming import ingest


def test_hull_volume():
    cube = np.array([(x, y, z) for x in (0, 1) for y in (0, 2) for z in (0, 3)], float)
    rng = np.random.default_rng(0)
    assert kernels.hull_volume(np.concatenate([cube, rng.uniform(0, 1, (200, 3))])) == pytest.approx(6)
    assert kernels.hull_volume(cube[:4]) == 0 and kernels.hull_volume(cube[:, [0, 1, 1]] * [1, 1, 0]) == 0 and kernels.hull_volume(np.zeros((9, 3))) == 0
    tetra = np.array([(0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1)], float)
    assert kernels.hull_volume(tetra) == pytest.approx(1 / 6)
    ball = rng.normal(size=(3000, 3))
    ball /= np.linalg.norm(ball, axis=1)[:, None]
    assert kernels.hull_volume(ball) == pytest.approx(4 * np.pi / 3, rel=0.02)


def test_polygons():
    square = np.array([(0, 0), (2, 0), (2, 2), (0, 2)], float)
    assert kernels.area(kernels.hull_2d(np.concatenate([square, [[1, 1]]]))) == 4
    assert kernels.area(kernels.clipped(square - 1, 5, 5)) == 1 and kernels.area(kernels.clipped(square + 9, 5, 5)) == 0
    assert kernels.footprints_overlap(square, square + 1) and kernels.footprints_overlap(square, square + [2.9, 0]) and not kernels.footprints_overlap(square, square + [3.1, 0])


def test_models_are_plug_ins(spark):
    class Doubler(kernels.Model):
        schema = "id long"

        def load(self):
            pass

        def call(self, batch):
            return pd.DataFrame({"id": batch["id"] * 2})

    assert [r.id for r in Doubler().apply(spark.range(3)).collect()] == [0, 2, 4]
    with pytest.raises(NotImplementedError):
        kernels.Model().load()


def test_valid_boxes(spark):
    rng = np.random.default_rng(1)
    pts = spark.createDataFrame([(1, *map(float, r)) for r in rng.uniform(-0.5, 0.5, (400, 3))], "s int, p_x double, p_y double, p_z double")
    boxes = spark.createDataFrame([(1, 7, 0.0, 0.0, 0.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0), (1, 8, 5.0, 0.0, 0.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0)], "s int, node_id int, c_x double, c_y double, c_z double, l_x double, l_y double, l_z double, e0 double, e1 double, e2 double")
    got = kernels.valid_boxes(pts, boxes, "s").collect()
    assert [(r.node_id, r.valid) for r in got] == [(7, True)] and 0.5 < got[0].share < 0.75


def test_scan_and_write(spark, tmp_path):
    df = spark.createDataFrame([(f"s{i // 10}", i) for i in range(100)], "scene_id string, view_idx int")
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    sinks.write_parquet(df.coalesce(1), one, 30)
    assert len(list((tmp_path / "one").glob("*.parquet"))) == 4
    sinks.write_by_scene(df, two, 3)
    spans = spark.read.parquet(two).select("scene_id", F.col("_metadata.file_name").alias("f")).distinct()
    assert spans.count() == 10
    assert readers.scan(spark, one, two, require=("scene_id",)).count() == 200
    assert sum(r.n for r in sinks.summary(spark.read.parquet(one)).collect()) == 100
    for bad in ((), (one, one), (str(tmp_path / "none"),)):
        with pytest.raises(ValueError):
            readers.scan(spark, *bad)
    with pytest.raises(ValueError):
        readers.scan(spark, one, require=("nope",))


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "1", "n": 2}\n\n{broken\n{"id": "2"}\n')
    (tmp_path / "b_scenes.jsonl").write_text('{"id": "9"}\n')
    schema = spark.range(0).select(F.lit("").alias("id"), F.lit(1).alias("n")).schema
    assert sorted(r.id for r in readers.json_lines(spark, str(tmp_path), schema).collect()) == ["1", "2"]


def test_matrices_and_intrinsics(spark, tmp_path):
    (tmp_path / "pose.txt").write_text("\n".join(" ".join(str(float(4 * r + c)) for c in range(4)) for r in range(4)))
    (tmp_path / "bad.txt").write_text("1 2 3")
    assert [r.matrix for r in readers.matrices(spark, str(tmp_path)).collect()] == [[float(i) for i in range(16)]]
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(readers.pinhole_line(F.lit("640 480 500 501 320 240")))[:7] == [500.0, 0.0, 320.0, 0.0, 0.0, 501.0, 240.0]
    assert one(readers.info_intrinsic(F.lit("x = 1\nm_calibrationDepthIntrinsic = " + " ".join(map(str, range(16))) + "\ny"))) == [float(i) for i in range(16)]
    assert one(readers.padded_4x4(F.array(*[F.lit(float(i)) for i in range(9)])))[:8] == [0.0, 1.0, 2.0, 0.0, 3.0, 4.0, 5.0, 0.0]
    assert one(readers.rendered_intrinsic(F.lit(2.0), F.lit(2.0), F.lit(101), F.lit(51)))[:3] == [100.0, 0.0, 50.0]


def test_depth_maps_and_listing(spark, tmp_path):
    (tmp_path / "scene1").mkdir()
    np.save(tmp_path / "scene1" / "0001.npy", np.array([[1000, 2000], [0, 4000]], np.uint16))
    files = spark.read.format("binaryFile").load(str(tmp_path / "scene1" / "0001.npy")).withColumn("depth_scale", F.lit(1000))
    assert sorted((r.u, r.v, r.d) for r in readers.depth_pixels(files).collect()) == [(0, 0, 1.0), (0, 1, 0.0), (1, 0, 2.0), (1, 1, 4.0)]
    assert [(r.scene_id, r.frame) for r in readers.listing(spark, str(tmp_path), r"/(scene\d+)/(\d+)\.npy$", ("scene_id", "frame")).collect()] == [("scene1", "0001")]


def test_segment_groups(spark, tmp_path):
    obb = {"centroid": [0.0, 1.0, 2.0], "axesLengths": [1.0, 2.0, 3.0], "normalizedAxes": [1.0, 0, 0, 0, 1.0, 0, 0, 0, 1.0]}
    (tmp_path / "a.json").write_text(json.dumps({"segGroups": [{"label": "chair", "obb": obb}]}))
    from vistaloom.operators.annotate import annotated_box

    r = readers.segment_groups(spark, str(tmp_path / "a.json")).select("label", annotated_box(F.col("centroid"), F.col("axes_lengths"), F.col("axes")).alias("box")).first()
    assert r.label == "chair" and r.box == pytest.approx([0, 1, 2, 1, 2, 3, 0, 0, 0])


def test_records(spark, tmp_path):
    turn = "array<struct<`from`:string,value:string>>"
    qa = spark.createDataFrame([(1, [("human", "<image> Q? A. x B. y"), ("gpt", "A")], ["p"])], f"ord int, messages {turn}, images array<string>")
    rows = sinks.records(numbered(qa, "ord", ranges=1), "mmsi_x", F.col("flat_idx"))
    r = rows.first()
    assert (r.id, r.image, r.input_type, r.output_type) == ("mmsi_x_00000000", ["00000000_view0.png"], "multiview", "MCQ") and r.conversations[0]["value"] == "Q? A. x B. y"
    sinks.write_records(rows, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1
    assert sinks.formats(None) == ["blink"] and sinks.formats(["parquet", "x"]) == ["parquet"] and sinks.record_root(None, None, "/r/") == "/r/05_blink"


CONFIG = """
pipeline:
  file_name: demo
  stages:
    first_stage:
      - {method: keep, output_dir: a, least: 2}
      - {method: keep, output_dir: b, least: 5, depends_on: first_stage/keep}
    last_stage:
      - {method: count, output_dir: c, depends_on: first_stage/keep#2}
"""


def test_plan(spark):
    plan = Plan.parse(CONFIG)
    assert [(t.name, t.source) for t in plan.tasks] == [("first_stage/keep", None), ("first_stage/keep#2", "first_stage/keep"), ("last_stage/count", "first_stage/keep#2")]
    written = []
    out = plan.run(spark.range(10), {"keep": lambda df, least: df.where(F.col("id") >= least), "count": lambda df: df.groupBy().count()}, lambda t, df: written.append(t.output))
    assert out["last_stage/count"].first()[0] == 5 and written == ["a", "b", "c"]
    with pytest.raises(ValueError):
        plan.run(spark.range(1), {"keep": None})


@pytest.mark.parametrize("text", ["x: 1", "pipeline: {stages: {}}", "pipeline: {stages: {s: [{method: a, output_dir: b}]}}", "pipeline: {file_name: f, stages: {s: [{method: a}]}}", "pipeline: {file_name: f, stages: {s: [{method: a, output_dir: b}, {method: c, output_dir: d}]}}", CONFIG.replace("keep#2", "nope"), CONFIG.replace("keep#2", "keep")])
def test_bad_plans(text):
    with pytest.raises(ValueError):
        Plan.parse(text)


def test_repeated_keys_and_parts():
    plan = Plan.parse("pipeline: {file_name: f, stages: {s: [{method: a, output_dir: x}], s: [{method: a, output_dir: y, depends_on: a}]}}")
    assert [t.name for t in plan.tasks] == ["s/a", "s/a#2"]
    assert parts(["x", "y"]) == [("part_1", "x"), ("part_2", "y")]
    with pytest.raises(ValueError):
        parts(["x", "x"])
    d = {"a": 1, "b": 2}
    assert quotas(d, None) == quotas(d, "all") == d and quotas(d, ["b"]) == {"a": 0, "b": 2} and quotas(d, {"a": 9}) == {"a": 9, "b": 0}


def test_templates(spark):
    rows = templates.table(spark).collect()
    assert {r.name for r in rows} == set(templates.TEMPLATES)
    p = spark.range(1).select(templates.prompt("position.height_higher", F.lit("s"), {"A": F.lit("lamp"), "B": F.lit("bed"), "X": F.lit("A")})).first()[0]
    assert p == "Which reaches higher, the lamp or the bed? Answer: A"


def test_ingest_resumes(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))
    df = spark.createDataFrame([(f"{i}", i) for i in range(5)], "id string, n int")
    df.write.parquet(src)
    ingest.ingest(spark, src, out, check, df.schema).awaitTermination()
    spark.createDataFrame([("4", 4), ("5", 5)], "id string, n int").write.mode("append").parquet(src)
    ingest.ingest(spark, src, out, check, df.schema).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [str(i) for i in range(6)]
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert sum(r.n for r in ingest.windowed(e, "ts", "event_type").collect()) == e.count()
