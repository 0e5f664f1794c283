"""Every registered scene query against its SQL, and the entry module."""

import os
import subprocess
import sys

import duckdb
import pandas as pd
import pytest

from vistaloom.plans import scene_queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def shown(df):
    value = lambda v: "None" if v is None or v is pd.NA or v != v else repr(float(v)) if isinstance(v, float) else str(v)
    cols = sorted(df.columns)
    return cols, sorted(tuple(value(v) for v in r) for r in df[cols].itertuples(index=False))


@pytest.mark.parametrize("name", scene_queries.queries())
def test_query(spark, sf_dir, sql, name):
    got = scene_queries.queries()[name](spark, sf_dir)
    oracle = scene_queries.oracle_sql().get(name)
    if oracle is None:
        assert got.count() > 0
    else:
        assert shown(got.toPandas()) == shown(sql.execute(oracle).df())


def test_entry_works_without_the_training_data_operators(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import sys; sys.modules['vistaloom.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert 'flatten' in q and 'pipeline' not in q and not any(k.startswith('op') for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=repo, check=True, timeout=120)


def test_plans_push_down(spark, sf_dir):
    """Scans read only what a query needs, and pairs join on the scene."""
    q = scene_queries.queries()
    plan = lambda n: q[n](spark, sf_dir)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<p_name" in plan("tag_histogram_topk") or "ReadSchema: struct<p_partkey" in plan("tag_histogram_topk")
    assert "p_retailprice" not in plan("tag_histogram_topk").split("Physical Plan")[1]
    for name in ("camera_pair_octant", "clockwise", "relative_distance_centers", "merge_boxes", "nn_distance", "voxel_range_join"):
        assert "CartesianProduct" not in plan(name)
