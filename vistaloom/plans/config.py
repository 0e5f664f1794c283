"""A YAML pipeline as a plan: a checked graph of named tasks over DataFrames.

    pipeline:
      file_name: demo
      stages:
        filter_stage:
          - {method: drop_walls, output_dir: out/filter, tags: [wall]}
        group_stage:
          - {method: merge, output_dir: out/group, depends_on: filter_stage/drop_walls}

A mapping may repeat a key; it then counts as a list of the values. A task is named stage/method, with
#2, #3, ... for repeats. depends_on names a task in full, or without its stage where only one task so
far has that name; the first task reads the input, all others must name what they read. Tasks are lazy:
a table is kept only if several tasks read it, and written where the plan is asked to.
"""

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

import yaml
from pyspark.sql import DataFrame

Operator = Callable[..., DataFrame]


class _Loader(yaml.SafeLoader):
    pass


def _mapping(loader: _Loader, node: yaml.MappingNode) -> Any:
    loader.flatten_mapping(node)
    pairs = [(loader.construct_object(k, deep=True), loader.construct_object(v, deep=True)) for k, v in node.value]
    keys = [k for k, _ in pairs]
    return dict(pairs) if len(set(keys)) == len(keys) else [{k: v} for k, v in pairs]


_Loader.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, _mapping)


@dataclass
class Task:
    name: str
    method: str
    output: str
    source: str | None
    options: dict[str, Any] = field(default_factory=dict)


@dataclass
class Plan:
    name: str
    tasks: list[Task]

    @classmethod
    def parse(cls, text: str) -> "Plan":
        config = yaml.load(text, _Loader)
        pipeline = config.get("pipeline") if isinstance(config, dict) else None
        if not isinstance(pipeline, dict) or not pipeline.get("stages"):
            raise ValueError("pipeline.stages is missing")
        if not pipeline.get("file_name"):
            raise ValueError("pipeline.file_name is missing")
        stages = pipeline["stages"]
        listed = [(k, v) for s in stages for k, v in s.items()] if isinstance(stages, list) else list(stages.items())
        tasks: list[Task] = []
        for stage, entries in listed:
            if not isinstance(entries, list):
                raise ValueError(f"{stage}: a list of tasks is needed")
            for entry in entries:
                if not isinstance(entry, dict) or not {"method", "output_dir"} <= entry.keys():
                    raise ValueError(f"{stage}: a task needs method and output_dir")
                rest = {k: v for k, v in entry.items() if k not in ("method", "output_dir", "depends_on")}
                base = f"{stage}/{entry['method']}"
                seen = sum(t.name == base or t.name.startswith(f"{base}#") for t in tasks)
                source = cls._resolve(entry.get("depends_on"), tasks, base)
                tasks.append(Task(base if not seen else f"{base}#{seen + 1}", entry["method"], entry["output_dir"], source, rest))
        return cls(pipeline["file_name"], tasks)

    @staticmethod
    def _resolve(ref: str | None, tasks: list[Task], name: str) -> str | None:
        if ref is None:
            if tasks:
                raise ValueError(f"{name}: depends_on is missing")
            return None
        exact = [t.name for t in tasks if t.name == ref or ref.endswith("#1") and t.name == ref[:-2]]
        found = exact or [t.name for t in tasks if t.name.split("/", 1)[1] == ref]
        if len(found) != 1 or (exact and "#" not in ref and any(t.name.startswith(f"{ref}#") for t in tasks)):
            raise ValueError(f"{name}: depends_on {ref!r} is {'ambiguous' if found else 'unknown'}")
        return found[0]

    def run(self, source: DataFrame, operators: dict[str, Operator], write: Callable[[Task, DataFrame], None] | None = None) -> dict[str, DataFrame]:
        """Tables by task. operators: method -> f(df, **options). write: called for every task, in order."""
        unknown = [t.method for t in self.tasks if t.method not in operators]
        if unknown:
            raise ValueError(f"unknown methods: {', '.join(unknown)}")
        readers = [t.source for t in self.tasks]
        out: dict[str, DataFrame] = {}
        for t in self.tasks:
            df = operators[t.method](source if t.source is None else out[t.source], **t.options)
            out[t.name] = df.persist() if readers.count(t.name) > 1 else df
            if write:
                write(t, out[t.name])
        return out


def parts(paths: list[str] | str) -> list[tuple[str, str]]:
    """(name, path) of each input file: several inputs make one run each, part_1, part_2, ..."""
    if isinstance(paths, str):
        return [("", paths)]
    if len(set(paths)) != len(paths):
        raise ValueError("an input is named twice")
    return [(f"part_{i}", p) for i, p in enumerate(paths, 1)]


def quotas(sub_tasks: dict[str, int], wanted: None | str | list[str] | dict[str, int]) -> dict[str, int]:
    """Questions per sub-task: the defaults, the defaults of those listed, or the numbers given."""
    if wanted is None or wanted == "all":
        return dict(sub_tasks)
    if isinstance(wanted, dict):
        return {k: int(wanted.get(k, 0)) for k in sub_tasks}
    return {k: n if k in wanted else 0 for k, n in sub_tasks.items()}
