"""Runs a YAML plan: python -m vistaloom.plans.cli --config plan.yaml --input scenes.parquet --output out

Several inputs make one run each, in folders part_1, part_2, ... Tasks that have written their table
(_SUCCESS) are read and not made again, so a run that was stopped goes on where it was.
"""

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from ..operators import annotate, tables
from ..sources import readers, sinks
from .config import Operator, Plan, Task, parts

#: Methods that a plan may name.
METHODS: dict[str, Operator] = {
    "flatten": tables.flatten,
    "group": tables.group,
    "merge_scenes": tables.merge_scenes,
    "flatten_qa": tables.flatten_qa,
    "filter_tags": lambda df, tags, columns, anchor="obj_tags": tables.without_tags(df, tuple(tags), columns, anchor),
    "filter_flags": tables.by_flags,
    "check_single": tables.single_checked,
    "check_multi": tables.multi_checked,
    "first_seen": tables.first_seen,
    "limit": tables.limited,
    "align": annotate.aligned,
    "kept_boxes": tables.kept_boxes,
    "where": lambda df, test: df.where(test),
    "select": lambda df, columns: df.select(*columns),
}


def run(spark: SparkSession, config: str, inputs: list[str], output: str, methods: dict[str, Operator] = METHODS, max_scenes: int | None = None, max_rows: int | None = None) -> dict[str, DataFrame]:
    """Tables by part and task. max_scenes and max_rows cut the input, for smoke runs."""
    plan, out = Plan.parse(config), {}
    for part, path in parts(inputs if len(inputs) > 1 else inputs[0]):
        source = readers.scan(spark, path)
        if max_scenes is not None or max_rows is not None:
            source = tables.limited(source, "scene_id", max_scenes, max_rows)
        folder = "/".join(x for x in (output.rstrip("/"), plan.name, part) if x)
        known: dict[str, DataFrame] = {}
        for task in plan.tasks:
            at = f"{folder}/{task.name.replace('#', '_dup')}"
            known[task.name] = _table(spark, task, at, known[task.source] if task.source else source, methods)
            out["/".join(x for x in (part, task.name) if x)] = known[task.name]
    return out


def _table(spark: SparkSession, task: Task, at: str, df: DataFrame, methods: dict[str, Operator]) -> DataFrame:
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        if task.method not in methods:
            raise ValueError(f"unknown method: {task.method}")
        sinks.write_parquet(methods[task.method](df, **task.options), at, mode="overwrite")
    return spark.read.parquet(at)


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--config", required=True)
    p.add_argument("--input", required=True, nargs="+")
    p.add_argument("--output", required=True)
    p.add_argument("--max-scenes", type=int)
    p.add_argument("--max-rows", type=int)
    a = p.parse_args(args)
    spark = SparkSession.builder.appName(os.path.basename(a.config)).getOrCreate()
    with open(a.config) as f:
        for name, df in run(spark, f.read(), a.input, a.output, max_scenes=a.max_scenes, max_rows=a.max_rows).items():
            print(f"{name}: {df.count()} rows")


if __name__ == "__main__":
    main()
