"""Sinks: sharded and scene-coherent Parquet, question records as JSON lines, point clouds as text."""

import functools
import os
import uuid

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import tables
from ..operators.graph import require_columns
from .shared import checkpointed

#: File formats of a task's output, and the folder of question records.
FORMATS, RECORDS = ("blink", "parquet"), "05_blink"


def write_parquet(df: DataFrame, path: str, rows_each: int = 1000, mode: str = "errorifexists") -> None:
    """Files of at most rows_each rows."""
    df.write.mode(mode).option("maxRecordsPerFile", rows_each).parquet(path)


def write_by_scene(df: DataFrame, path: str, files: int | None = None, mode: str = "errorifexists", rows_each: int | None = None) -> None:
    """No scene spans two files: one exchange by scene, sorted within.

    Either a number of files, or a target of rows_each rows: scenes in order fill a file until it has that
    many. Which file a scene goes to is a prefix sum over scenes, a row a scene.
    """
    require_columns(df, "scene_id")
    if rows_each is None:
        df.repartition(files or 1, "scene_id").sortWithinPartitions("scene_id").write.mode(mode).parquet(path)
        return
    sizes = checkpointed(numbered_sizes(df))
    files = int(sizes.agg(F.coalesce(F.max("__before"), F.lit(0))).first()[0]) // rows_each + 1
    to = sizes.select("scene_id", F.floor(F.col("__before") / rows_each).cast("int").alias("__file"))
    out = df.join(to, df["scene_id"].eqNullSafe(to["scene_id"])).drop(to["scene_id"])
    out.repartitionById(files, "__file").sortWithinPartitions("scene_id").drop("__file").write.mode(mode).parquet(path)


def numbered_sizes(df: DataFrame) -> DataFrame:
    """(scene_id, __before): rows of all scenes before, in order of scene_id; the window sees a row a scene."""
    n = df.groupBy("scene_id").agg(F.count("*").alias("__n"))
    before = Window.orderBy("scene_id").rowsBetween(Window.unboundedPreceding, -1)
    return n.select("scene_id", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def records(qa: DataFrame, task: str, index: Column) -> DataFrame:
    """Question records from rows (messages, images, question_tags, question_types, cognitive_map,
    sub_task, data_source). `index` numbers them (tables.numbered): the record's id."""
    require_columns(qa, "messages")
    have = lambda c, kind: F.col(c) if c in qa.columns else F.lit(None).cast(kind)
    human = F.array_join(F.transform(F.filter("messages", lambda m: m["from"] == "human"), lambda m: m["value"]), " ")
    images = have("images", "array<string>")
    place = F.format_string("%08d", index)
    names = F.transform(F.coalesce(images, F.array().cast("array<string>")), lambda _, i: F.concat(place, F.lit("_view"), i.cast("string"), F.lit(".png")))
    plain = F.transform("messages", lambda m: F.struct(m["from"].alias("from"), F.when(m["from"] == "human", tx.without_images(m["value"])).otherwise(m["value"]).alias("value")))
    others = F.struct(have("question_tags", "array<string>").alias("question_tags"), have("question_types", "string").alias("question_types"), have("cognitive_map", "string").alias("cognitive_map"))
    return qa.select(
        F.concat(F.lit(f"{task}_"), place).alias("id"), names.alias("image"), F.array().cast("array<string>").alias("video"), plain.alias("conversations"), F.lit(task).alias("task"),
        tx.input_type(F.lit(task)).alias("input_type"), tx.output_type(human).alias("output_type"), have("data_source", "string").alias("data_source"), have("sub_task", "string").alias("sub_task"), others.alias("others"),
    )


def write_records(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_images(rows: DataFrame, path: str, root: str) -> DataFrame:
    """Writes each row's images (name, bytes) as files below root, on the workers, and gives (name, size).

    root is a folder that all workers share. A file is written under a new name and then renamed, so that
    a repeated task leaves the same files. rows: images array<struct<name,bytes>>.
    """

    def go(batches):
        where, top = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)
        for pdf in batches:
            done = []
            for name, data in zip(pdf["name"], pdf["bytes"]):
                at = f"{top.rstrip('/')}/{path}/{name}"
                where.create_dir(os.path.dirname(at), recursive=True)
                fresh = f"{at}.{uuid.uuid4().hex}"
                with where.open_output_stream(fresh) as f:
                    f.write(data)
                where.move(fresh, at)
                done.append(len(data))
            yield pd.DataFrame({"name": pdf["name"], "size": done})

    return rows.select(F.inline("images")).select("name", "bytes").mapInPandas(go, "name string, size long")


def task_of(path: Column) -> Column:
    """The task that a file of questions belongs to: the folder after annotation_stage, else what follows
    the pipeline's prefix in a folder name, else the folder that the file is in."""
    stage = F.regexp_extract(path, r"/annotation_stage/([^/]+)/", 1)
    prefix = F.regexp_extract(path, r"/base_pipeline_demo_([^/]+)/", 1)
    parent = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    return F.when(stage != "", stage).when(prefix != "", prefix).otherwise(parent)


def converted(spark: SparkSession, root: str, merge: bool = False) -> dict[str, DataFrame]:
    """Question records of all tasks' Parquet files below root (data.parquet, data_part_N.parquet), a table
    a task, or one table "all". Files are told apart by their paths; records are numbered within their
    table in the order of path and row."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "data{,_part_*}.parquet").load(root)
    names = [(r["path"], r["task"]) for r in files.select("path", task_of(F.col("path")).alias("task")).collect()]  # a row a file
    out = {}
    for task in sorted({t for _, t in names}):
        qa = spark.read.option("mergeSchema", "true").parquet(*sorted(p for p, t in names if t == task))
        qa = qa.select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__row"))
        out[task] = records(tables.numbered(qa, "__path", "__row"), task, F.col("flat_idx"))
    if not merge or not out:
        return out
    return {"all": functools.reduce(lambda a, b: a.unionByName(b), out.values())}


def formats(wanted: list[str] | None) -> list[str]:
    """Output formats of a task; unknown names are dropped, none means question records."""
    return [f for f in wanted or ["blink"] if f in FORMATS] or ["blink"]


def record_root(task: str | None, parent: str | None, root: str) -> str:
    """Folder of question records: the task's own, then $BLINK_OUT_DIR, then beside the parent, then under root."""
    return task or os.environ.get("BLINK_OUT_DIR") or f"{(parent or root).rstrip('/')}/{RECORDS}"


def point_lines(points: DataFrame) -> DataFrame:
    """Points as text lines "v x y z"."""
    return points.select(F.format_string("v %.6f %.6f %.6f", "p_x", "p_y", "p_z").alias("value"))


def cloud_files(points: DataFrame, keys: list[str], suffix: str = ".pcd") -> DataFrame:
    """(images array<struct<name,bytes>>) for write_images: an ASCII point cloud file of each key's points, .pcd
    or .ply, named by the key."""

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        n = len(pdf)
        if suffix == ".ply":
            head = ["ply", "format ascii 1.0", f"element vertex {n}", "property float x", "property float y", "property float z", "end_header"]
        else:
            head = ["VERSION .7", "FIELDS x y z", "SIZE 4 4 4", "TYPE F F F", "COUNT 1 1 1", f"WIDTH {n}", "HEIGHT 1", "VIEWPOINT 0 0 0 1 0 0 0", f"POINTS {n}", "DATA ascii"]
        lines = [f"{x:.6f} {y:.6f} {z:.6f}" for x, y, z in zip(pdf["p_x"], pdf["p_y"], pdf["p_z"])]
        return pd.DataFrame({"images": [[{"name": "_".join(map(str, key)) + suffix, "bytes": "\n".join([*head, *lines, ""]).encode()}]]})

    return points.groupBy(*keys).applyInPandas(one, "images array<struct<name:string,bytes:binary>>")


def summary(df: DataFrame) -> DataFrame:
    """Rows per file of a table that was read."""
    return df.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n"))
