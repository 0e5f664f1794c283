"""Scans: frames and scenes, tolerant JSON lines, matrix and intrinsic text, images and depth maps."""

import io
import pickle
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.graph import require_columns
from . import png

_BOX = T.ArrayType(T.DoubleType())
FRAME = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "dataset", "scene_id", "image", "depth_map", "pose", "intrinsic", "axis_align_matrix")]
    + [T.StructField("depth_scale", T.IntegerType()), T.StructField("is_metric_depth", T.BooleanType()), T.StructField("obj_tags", T.ArrayType(T.StringType())), T.StructField("bboxes_3d_world_coords", T.ArrayType(_BOX))]
)


def scan(spark: SparkSession, *paths: str, require: tuple[str, ...] = (), schema: T.StructType | None = None) -> DataFrame:
    """Parquet files or folders as one table with the column `part` naming each row's file.

    ValueError for no paths, a path named twice, a missing path or a missing column.
    """
    if not paths:
        raise ValueError("no input paths")
    twice = {p for p in paths if paths.count(p) > 1}
    if twice:
        raise ValueError(f"named twice: {', '.join(sorted(twice))}")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        if not at.getFileSystem(conf).globStatus(at):
            raise ValueError(f"no such input: {p}")
    reader = spark.read.schema(schema) if schema else spark.read
    return require_columns(reader.parquet(*paths).withColumn("part", F.col("_metadata.file_name")), *require)


def snapshot(name: str, root: str, split: str = "train") -> str:
    """Where a published data set "owner/name" lies below a folder of local snapshots; other paths as they
    are. Nothing is fetched."""
    return f"{root.rstrip('/')}/{name}/{split}*.parquet" if re.fullmatch(r"[\w-]+/[\w-]+", name) else name


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines without blank and broken ones; files of whole scenes (*_scenes.jsonl) are left out."""
    bad = "__broken"
    wide = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    rows = spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad).json(path)
    rows = rows.where(~F.col("_metadata.file_name").endswith("_scenes.jsonl"))
    some = F.coalesce(*[F.col(f.name).cast("string") for f in schema.fields]).isNotNull()
    return rows.where(F.col(bad).isNull() & some).drop(bad)


def numbers(text: Column) -> Column:
    """All numbers of a text as array<double>."""
    return F.transform(F.filter(F.split(F.trim(text), r"[\s,;\[\]]+"), lambda x: x != ""), lambda x: x.cast("double"))


def matrices(spark: SparkSession, path: str, size: int = 16) -> DataFrame:
    """(path, matrix): whole text files of `size` numbers, row by row; others are left out."""
    t = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), numbers(F.col("value")).alias("matrix"))
    return t.where(F.size("matrix") == size)


def matrix_4x4(fx: Column, fy: Column, cx: Column, cy: Column) -> Column:
    zero, one = F.lit(0.0), F.lit(1.0)
    return F.array(fx, zero, cx, zero, zero, fy, cy, zero, zero, zero, one, zero, zero, zero, zero, one)


def pinhole_line(text: Column) -> Column:
    """4x4 intrinsics of a line "width height fx fy cx cy"."""
    n = numbers(text)
    return F.when(F.size(n) >= 6, matrix_4x4(*[F.get(n, F.lit(i)) for i in (2, 3, 4, 5)]))


def info_intrinsic(text: Column, name: str = "m_calibrationDepthIntrinsic") -> Column:
    """4x4 intrinsics of a "name = 16 numbers" line in an info file."""
    n = numbers(F.regexp_extract(text, rf"{re.escape(name)}\s*=\s*([^\n]*)", 1))
    return F.when(F.size(n) == 16, n)


def padded_4x4(matrix: Column) -> Column:
    """A 3x3, 3x4 or 4x4 matrix (9, 12 or 16 numbers) as 16."""
    at = lambda i: F.get(matrix, F.lit(i))
    zero, one = F.lit(0.0), F.lit(1.0)
    last = [zero, zero, zero, one]
    nine = F.array(*[x for r in range(3) for x in (at(3 * r), at(3 * r + 1), at(3 * r + 2), zero)], *last)
    return F.when(F.size(matrix) == 16, matrix).when(F.size(matrix) == 12, F.concat(matrix, F.array(*last))).when(F.size(matrix) == 9, nine)


def rendered_intrinsic(m00: Column, m11: Column, width: Column, height: Column) -> Column:
    """4x4 intrinsics from a projection matrix's scales and the image size."""
    w, h = (width - 1) / 2, (height - 1) / 2
    return matrix_4x4(m00 * w, m11 * h, w, h)


def listing(spark: SparkSession, path: str, pattern: str, names: tuple[str, ...], glob: str = "*") -> DataFrame:
    """File paths below a folder, taken apart by a pattern's groups; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path")
    found = files.where(F.col("path").rlike(pattern))
    return found.select("path", *[F.regexp_extract("path", pattern, i + 1).alias(n) for i, n in enumerate(names)])


def segment_groups(spark: SparkSession, path: str) -> DataFrame:
    """(path, label, centroid, axes_lengths, axes): oriented boxes of a scene's annotation JSON."""
    schema = "segGroups array<struct<label:string,obb:struct<centroid:array<double>,axesLengths:array<double>,normalizedAxes:array<double>>>>"
    rows = spark.read.schema(schema).option("multiLine", "true").json(path)
    s = rows.select(F.col("_metadata.file_path").alias("path"), F.explode("segGroups").alias("s"))
    return s.select("path", "s.label", "s.obb.centroid", F.col("s.obb.axesLengths").alias("axes_lengths"), F.col("s.obb.normalizedAxes").alias("axes"))


def _picture(content: bytes) -> np.ndarray:
    return np.load(io.BytesIO(content), allow_pickle=False) if content[:6] == b"\x93NUMPY" else png.decode(content)


def depth_pixels(files: DataFrame, scale: str = "depth_scale", step: int = 1) -> DataFrame:
    """(path, u, v, d) of depth maps, .npy or PNG of 8 or 16 bits, in binaryFile rows (path, content,
    scale): values over the scale if there is one. Every step-th pixel both ways; images never leave the
    workers."""

    def go(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                d = _picture(r.content)
                d = (d[:, :, 0] if d.ndim == 3 else d)[::step, ::step].astype(float)
                if r.scale is not None and r.scale == r.scale and r.scale:
                    d = d / r.scale
                v, u = np.indices(d.shape)
                yield pd.DataFrame({"path": r.path, "u": u.ravel() * step, "v": v.ravel() * step, "d": d.ravel()})

    rows = files.select("path", "content", F.col(scale).cast("double").alias("scale"))
    return rows.mapInPandas(go, "path string, u long, v long, d double")


def rgb_images(files: DataFrame) -> DataFrame:
    """(path, width, height, rgb) of PNG images in binaryFile rows: three bytes a pixel, row by row; grey is
    spread over the three, transparency is left out and 16 bits are cut to 8. JPEG needs a plug-in."""

    def go(batches):
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                x = png.decode(content)
                x = (x >> 8).astype(np.uint8) if x.dtype == np.uint16 else x
                x = x[:, :, :3] if x.shape[2] > 2 else np.repeat(x[:, :, :1], 3, axis=2)
                out.append((path, x.shape[1], x.shape[0], x.tobytes()))
            yield pd.DataFrame(out, columns=["path", "width", "height", "rgb"])

    return files.select("path", "content").mapInPandas(go, "path string, width int, height int, rgb binary")


def png_images(images: DataFrame) -> DataFrame:
    """(path, image struct<bytes>) of (path, width, height, rgb) rows, as rgb_images gives them."""

    def go(batches):
        for pdf in batches:
            data = [{"bytes": png.encode(np.frombuffer(x, np.uint8).reshape(h, w, 3))} for w, h, x in zip(pdf["width"], pdf["height"], pdf["rgb"])]
            yield pd.DataFrame({"path": pdf["path"], "image": data})

    return images.mapInPandas(go, "path string, image struct<bytes:binary>")


class _Plain(pickle.Unpickler):
    """Reads lists, dicts, numbers, texts and numpy arrays; anything else in a pickle is refused."""

    ARRAYS = {("_reconstruct", "multiarray"), ("scalar", "multiarray"), ("ndarray", "numpy"), ("dtype", "numpy")}

    def find_class(self, module, name):
        if module.split(".")[0] == "numpy" and (name, module.split(".")[-1]) in self.ARRAYS:
            return super().find_class(module, name)
        raise pickle.UnpicklingError(f"refused: {module}.{name}")


def annotations(files: DataFrame, names: str = "data_list") -> DataFrame:
    """(path, place, sample_idx, img_path, cam2img) of pickled annotation lists in binaryFile rows: a row an
    image, cam2img as 16 numbers. Only plain values are unpickled. Of samples whose id has an image already
    the first in order stays (tables.first_seen does so by any key)."""

    def go(batches):
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                data = _Plain(io.BytesIO(content)).load()
                place = 0
                for sample in data[names] if isinstance(data, dict) else data:
                    for image in sample.get("images", []):
                        m = np.asarray(image.get("cam2img", sample.get("cam2img", [])), float)
                        full = np.eye(4)
                        full[: m.shape[0], : m.shape[1]] = m if m.ndim == 2 else full[:0, :0]
                        out.append((path, place, str(sample["sample_idx"]), str(image["img_path"]), full.ravel().tolist() if m.ndim == 2 else None))
                        place += 1
            yield pd.DataFrame(out, columns=["path", "place", "sample_idx", "img_path", "cam2img"])

    rows = files.select("path", "content").mapInPandas(go, "path string, place int, sample_idx string, img_path string, cam2img array<double>")
    first = rows.groupBy("path", "sample_idx", "img_path").agg(F.min("place").alias("place"))
    return rows.join(first, ["path", "sample_idx", "img_path", "place"], "left_semi")


def csv_rows(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """CSV files with a header as text columns; of rows of one key the first of its file stays."""
    rows = spark.read.option("header", "true").csv(path)
    if key is None:
        return rows
    named = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.monotonically_increasing_id().alias("__at"))
    rest = [c for c in rows.columns if c != key]
    return named.groupBy("__file", key).agg(F.min_by(F.struct(*rest), "__at").alias("__x")).select(*[F.col("__x").getField(c).alias(c) if c in rest else F.col(c) for c in rows.columns])


def scene_frames(rgb: DataFrame, depth: DataFrame, pose: DataFrame, intrinsic: DataFrame) -> DataFrame:
    """Frames (scene_id, frame_name, image, depth_map, pose, intrinsic) that have all four files: listings
    of (scene_id, frame_name, path) joined on scene and frame; intrinsics are of a frame or, without a
    frame_name, of the scene."""
    on = ["scene_id", "frame_name"]
    own = on if "frame_name" in intrinsic.columns else ["scene_id"]
    out = rgb.select(*on, F.col("path").alias("image"))
    for df, name, keys in ((depth, "depth_map", on), (pose, "pose", on), (intrinsic, "intrinsic", own)):
        out = out.join(df.groupBy(*keys).agg(F.min("path").alias(name)), keys)
    return out
