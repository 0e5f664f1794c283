import re

import duckdb
import pytest

from vistaloom.llm import mixing, queries


def brute_targets(sizes, weights=(5.0, 2.0, 1.0), most=3):
    """Reshares the excess until none is above; sizes in source order."""
    total, w = sum(sizes), [weights[i % len(weights)] for i in range(len(sizes))]
    full = set()
    while True:
        open_ = [i for i in range(len(sizes)) if i not in full]
        left = total - sum(most * sizes[i] for i in full)
        t = [most * sizes[i] if i in full else left * w[i] / sum(w[k] for k in open_) for i in range(len(sizes))]
        above = {i for i in open_ if t[i] > most * sizes[i]}
        if not above:
            return t
        full |= above


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 1000, 5, 70, 0], [0, 0], [10], [3, 2, 100_000, 7, 7, 1]])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(f"s{i:02}", n) for i, n in enumerate(sizes)], "source_key string, source_size long")
    got = [r.target for r in mixing.targets(df).orderBy("source_key").collect()]
    assert got == pytest.approx(brute_targets(sizes))


def test_mix(odd, none):
    rows = mixing.planned(odd).collect()
    assert len(rows) == odd.count() and mixing.planned(none).count() == 0
    words = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    assert sorted(r.size for r in rows) == sorted(words(r.text) for r in odd.collect())
    for size in {r.source_size for r in rows}:
        own = [r for r in rows if r.source_size == size]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    mix = mixing.mixed(odd)
    assert mix.columns == odd.columns and mixing.mixed(none).count() == 0
    assert sum(words(r.text) for r in mix.collect()) == sum(r.taken for r in rows)


def test_reruns_and_other_partitions_agree(odd):
    key = lambda df: sorted(map(str, df.collect()))
    assert key(mixing.planned(odd)) == key(mixing.planned(odd.repartition(7)))


def test_query_equals_sql(spark, sf_dir):
    got = queries.queries()["op9_mixing"](spark, sf_dir).collect()
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    want = con.execute(f"select doc_id, size, source_size, target, taken from ({queries.OP9_SQL})").fetchall()
    assert sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got) == sorted(want)
