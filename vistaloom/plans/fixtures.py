"""A deterministic scene projection of the test tables: views, objects, appearances, pixels, boxes.

Whole-number arithmetic only, so that another engine can make the same scenes (oracle.py does).
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tenth(c: Column, factor: int, mod: int, less: float) -> Column:
    return ((c * factor) % mod) / F.lit(10.0) - F.lit(less)


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posed cameras of a scene (a user) in time order, all of them."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", F.col("user_id").alias("scene_id"))
    scene = Window.partitionBy("scene_id")
    v = e.select("scene_id", "event_id", (F.row_number().over(scene.orderBy("ts", "event_id")) - 1).cast("long").alias("view_idx"), F.count("*").over(scene).alias("n"))
    i = F.col("event_id")
    v = v.select("scene_id", "view_idx", "event_id", "n", _tenth(i, 31, 211, 10.5).alias("pos_x"), _tenth(i, 47, 223, 11.1).alias("pos_y"), (F.lit(1.2) + ((i * 13) % 9) / F.lit(10.0)).alias("pos_z"), F.radians(((i * 37) % 360).cast("double")).alias("yaw"), F.radians(((i * 11) % 41 - 20).cast("double")).alias("pitch"))
    v = v.select("*", F.sin("yaw").alias("sy"), F.cos("yaw").alias("cy"), F.sin("pitch").alias("sp"), F.cos("pitch").alias("cp"))
    sy, cy, sp, cp = map(F.col, ("sy", "cy", "sp", "cp"))
    axes = {"right": (sy, -cy, F.lit(0.0)), "down": (sp * cy, sp * sy, -cp), "fwd": (cp * cy, cp * sy, sp)}
    return v.select("scene_id", "view_idx", "event_id", "n", "pos_x", "pos_y", "pos_z", *[c.alias(f"{n}_{k}") for n, a in axes.items() for c, k in zip(a, "xyz")])


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged oriented boxes of a scene; the number of scenes is that of the users, as one small row."""
    u = table(spark, sf_dir, "events").agg((F.max("user_id") + 1).alias("u"))
    p = table(spark, sf_dir, "part").crossJoin(F.broadcast(u))  # one row
    k = F.col("p_partkey")
    size = F.col("p_size").cast("long")
    return p.select(
        (k % F.col("u")).alias("scene_id"),
        k.alias("node_id"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("tag"),
        _tenth(k, 37, 199, 9.9).alias("c_x"), _tenth(k, 53, 197, 9.8).alias("c_y"), (((k * 29) % 31) / F.lit(10.0)).alias("c_z"),
        (F.lit(0.2) + (size % 10) / F.lit(10.0)).alias("l_x"), (F.lit(0.2) + ((k * 7) % 11) / F.lit(10.0)).alias("l_y"), (F.lit(0.2) + (size % 7) / F.lit(5.0)).alias("l_z"),
        F.radians(((k * 41) % 360 - 180).cast("double")).alias("e0"), F.radians(((k * 17) % 61 - 30).cast("double")).alias("e1"), F.radians(((k * 23) % 360 - 180).cast("double")).alias("e2"),
    )


def appearances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scene_id, view_idx, node_id): which view sees which object."""
    v, o = views(spark, sf_dir).select("scene_id", "view_idx", "event_id"), objects(spark, sf_dir).select("scene_id", "node_id")
    return v.join(o, "scene_id").where((F.col("event_id") * 7 + F.col("node_id") * 13) % 4 == 0).select("scene_id", "view_idx", "node_id")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object pixels with depth; a multiset."""
    t = table(spark, sf_dir, "lineitem")
    return t.select(F.col("l_suppkey").alias("frame_id"), F.col("l_linenumber").alias("obj_idx"), (F.col("l_partkey") % 64).alias("u"), (F.col("l_suppkey") % 48).alias("v"), (F.col("l_quantity") / F.lit(10.0)).alias("d"))


def boxes2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    t = table(spark, sf_dir, "part").select((k % 97).alias("frame_id"), k.alias("obj_idx"), F.lower("p_type").alias("tag"), ((k * 7) % 20).alias("x1"), ((k * 11) % 20).alias("y1"), F.col("p_size").cast("long").alias("s"), ((k * 3) % 10).alias("t"))
    return t.select("frame_id", "obj_idx", "tag", "x1", "y1", (F.col("x1") + 5 + F.col("s") % 10).alias("x2"), (F.col("y1") + 5 + F.col("t")).alias("y2"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as messages: (scene_id, pos, from, value)."""
    t = table(spark, sf_dir, "conversations")
    who = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise(F.col("role"))
    return t.select(F.col("conv_id").alias("scene_id"), F.col("turn").alias("pos"), who.alias("from"), F.col("text").alias("value"))
