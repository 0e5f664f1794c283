"""Helpers shared by the training-data operators."""

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but these characters.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
LEAST = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _top(spark: SparkSession) -> str:
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = f"file://{tempfile.gettempdir()}/vistaloom-{os.getpid()}"
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/vistaloom-{spark.sparkContext.applicationId}"


def shared_dir(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir).

    Only where the setting is absent and all runs in one process (local tests) a temporary folder
    takes its place. cleared() removes all such paths of an application.
    """
    return f"{_top(spark)}/{uuid.uuid4().hex}"


def cleared(spark: SparkSession) -> None:
    """Removes every intermediate table of this application: call it when results are written."""
    remove(spark, _top(spark))


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: lineage ends there and a lost executor loses nothing."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder through Spark's own file system layer."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have in any case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of a row, of any type."""
    return F.xxhash64(*[F.to_json(F.struct(F.col(f"`{f.name}`").alias("x"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema], F.lit(0))


def bounds(df: DataFrame, key: str, rows_each: int = 4000, most: int = 100_000) -> list[int]:
    """Lower bounds of ranges of a long column with about rows_each rows: values of it, ascending.

    An aggregation with partial sketches; what reaches the driver is at most `most` numbers. The
    sketch is ten times as fine as the ranges. Empty input: no bounds.
    """
    n = df.count()
    if not n:
        return []
    parts = max(1, min(most, n // rows_each))
    at = [i / parts for i in range(parts)]
    row = df.agg(F.min(key).alias("least"), F.percentile_approx(key, at, max(20_000, 10 * parts)).alias("cuts")).first()
    return sorted({row["least"], *row["cuts"][1:]})


def range_key(id_: Column, text: Column) -> Column:
    """A long, never null, that ascends as: rows without an id by a hash of their text, then ids. So rows
    without an id spread over ranges like others. (Ids below -2**62 share the least key of ids.)"""
    none = F.lit(LEAST) + F.shiftrightunsigned(F.xxhash64(text), 2)
    return F.when(id_.isNull(), none).otherwise(F.greatest(id_.cast("long"), F.lit(-(2**62))))


def numbers(values: list[int]) -> Column:
    """array<bigint> literal from one string: a list of many literals takes long to build."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def range_of(key: Column, cuts: list[int]) -> Column:
    """Number of the range that holds key (at least cuts[0]): a binary search in JVM expressions."""
    if len(cuts) < 2:
        return F.lit(0)
    steps = [2**i for i in reversed(range(len(cuts).bit_length()))]
    table_ = numbers(cuts)
    return F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda at, step: F.when((at + step < len(cuts)) & (F.get(table_, at + step) <= key), at + step).otherwise(at),
    )


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is worked out once: a lambda's variable, where a column would be put in
    anew at every use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
