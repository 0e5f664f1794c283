import numpy as np
import pytest
from pyspark.sql import functions as F

from vistaloom.llm import neighbours, queries


def brute(rows, asks, k=20):
    """rows: (id, vector); exact answers by query id."""
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    out = {}
    for i, v in rows:
        if asks(i):
            score = x @ np.array(v, np.float64)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        got = out.setdefault(r.query_id, [])
        assert r.rank == len(got) + 1
        got.append((r.vec_id, r.score))
    return out


def test_recall(spark):
    """22 parts, over the larger embeddings: at least 0.9 of the true neighbours, best first."""
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    got = answers(queries.queries()["op6_neighbours"](spark, "/root/testdata/sf0.1"))
    want = brute(rows, lambda i: i % 20 == 0)
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    true = {q: dict(w) for q, w in brute(rows, lambda i: i % 20 == 0, len(rows)).items()}
    for q, g in got.items():
        assert [s for _, s in g] == pytest.approx([true[q][i] for i, _ in g]) and g == sorted(g, key=lambda x: (-x[1], x[0]))


def test_whole_answers_where_all_parts_are_visited(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(neighbours, "RECALL", 2.0)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got, want = answers(queries.queries()["op6_neighbours"](spark, sf_dir)), brute(rows, lambda i: i % 20 == 0)
    assert {q: [i for i, _ in g] for q, g in got.items()} == {q: [i for i, _ in w] for q, w in want.items()}


@pytest.mark.parametrize("block", [3, 8192])
def test_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    monkeypatch.setattr(neighbours, "parts_for", lambda n: 7)
    rng = np.random.default_rng(3)
    good = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(1, 60)]  # many ties
    good = [(i, v) for i, v in good if any(v)]
    good += [(i, [1.0, 2.0, 2.0, -1.0]) for i in range(100, 180)]  # copies
    bad = [(300, None), (320, [0.0] * 4), (340, [1.0, None, 0.0, 0.0]), (360, [float("nan"), 1.0, 1.0, 1.0]), (380, [float("inf"), 1.0, 0.0, 0.0]), (400, [1.0, 2.0]), (420, []), (None, [1.0, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in good + bad + good[:5]], "vec_id long, embedding array<double>, rep string, part int, id int")
    monkeypatch.setattr(neighbours, "RECALL", 2.0)  # all parts: exact
    got = answers(neighbours.nearest(df, F.col("vec_id") % 20 == 0))
    want = brute(good, lambda i: i % 20 == 0)
    assert got == {q: [(i, pytest.approx(s)) for i, s in w] for q, w in want.items()}
    assert neighbours.nearest(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.nearest(df.where("vec_id = 20"), F.col("vec_id") % 20 == 0).count() == 0


def test_parts_are_balanced():
    x = np.random.default_rng(1).normal(size=(600, 8))
    label = neighbours.balanced_parts(x, neighbours.neighbour_graph(x, 5), 7)
    assert np.bincount(label, minlength=7).max() <= 1.05 * 600 / 7 + 1


def test_clustered_vectors_need_few_parts(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(60, 16)) * 4
    rows = [(i, (centres[i % 60] + rng.normal(size=16)).tolist()) for i in range(6000)]
    seen = []
    learn = neighbours.learn

    def spy(*args):
        seen.append((args[1], learn(*args)))
        return seen[-1][1]

    neighbours.learn = spy
    try:
        got = answers(neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0))
    finally:
        neighbours.learn = learn
    rows = [(i, np.float32(v).astype(float).tolist()) for i, v in rows]
    want = brute(rows, lambda i: i % 20 == 0)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    parts, (_, probes) = seen[0]
    assert parts == neighbours.parts_for(6000) == 39 and probes <= parts // 3


def test_shelves():
    first, many, n = neighbours._shelves({0: 3, 1: 2, 2: 30, 3: 1, 4: 9, 6: 4}, 7, 10)
    assert (first, many, n) == ([0, 0, 1, 4, 5, 5, 6], [1, 1, 3, 1, 1, 1, 1], 7)
