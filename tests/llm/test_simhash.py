import re

import numpy as np
import pytest
import xxhash

from vistaloom.llm import queries, simhash
from vistaloom.llm.components import connected_components


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints):
    """Smallest id reachable over links of 3 or fewer bits; prints: (id, fingerprint) rows."""
    up = list(range(len(prints)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    p = np.array([f for _, f in prints], np.uint64)
    for i in range(len(p)):
        for j in np.flatnonzero(np.bitwise_count(p[i] ^ p[i + 1 :]) <= 3) + i + 1:
            a, b = find(i), find(int(j))
            up[max(a, b)] = min(a, b)
    groups = {}
    for i, (k, _) in enumerate(prints):
        groups.setdefault(find(i), []).append(k)
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return [least[find(i)] for i in range(len(prints))]


def check(docs, out):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    want = sorted((str(i), f"{f:016x}", str(c)) for (i, f), c in zip(prints, classes(prints)))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in out.collect()) == want


def test_query_equals_brute_force(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"), queries.queries()["op8_simhash"](spark, sf_dir))


def test_odd_rows(odd, none):
    check(odd, simhash.near_duplicates(odd))
    assert simhash.near_duplicates(none).count() == 0


def test_links_join_what_brute_force_joins(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    many = np.full(2500, base[0])  # a dense subtrie, which is divided again
    for _ in range(3):
        many = many ^ (np.uint64(1) << rng.integers(0, 64, len(many)).astype(np.uint64))
    edge = base ^ np.uint64(2**63 + 2**15 + 2**31)
    p = np.unique(np.concatenate([base, many, edge, edge ^ np.uint64(2**47)]))
    frame = spark.createDataFrame([(int(x),) for x in p.view(np.int64)], "fp long")
    roots = {r.node: r.root for r in connected_components(simhash.near_links(frame)).collect()}
    got = {}
    for x in p.view(np.int64).tolist():
        got.setdefault(roots.get(x, x), set()).add(x)
    want = {}
    for x, c in zip(p.view(np.int64).tolist(), classes([(i, x) for i, x in enumerate(p)])):
        want.setdefault(c, set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("finish", [0, 100, 10_000])
def test_components_of_a_long_chain(spark, finish):
    links = spark.createDataFrame([(i * 7919 % 1000, (i + 1) * 7919 % 1000) for i in range(998)] + [(5000, 5001), (None, 3), (4, 4)], "a long, b long")
    roots = connected_components(links, finish=finish).collect()
    assert len(roots) == 1001 and len({r.root for r in roots}) == 2
    assert connected_components(links.where("false")).count() == 0


def test_keep_one(odd, none):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    out = kept.collect()
    prints = [brute_fingerprint(r.text) for r in out]
    rows = [(k, p) for k, p in enumerate(prints)]
    assert classes(rows) == list(range(len(out)))  # no two of one class
    assert {r.doc_id for r in out} >= {1, 2, 9, 12, -5}
    assert simhash.keep_one(none).count() == 0


def test_keep_one_of_rows_that_differ_elsewhere(spark):
    rows = [(7, "same text here", f"v{k}") for k in range(8)] * 2 + [(9, "other words there now", "x")] * 3
    frame = spark.createDataFrame(rows, "__id long, `__text` string, __no string")
    got = {tuple(map(tuple, simhash.keep_one(frame.repartition(n), "__id", "__text").orderBy("__id").collect())) for n in (1, 3, 5)}
    assert len(got) == 1 and [r[0] for r in got.pop()] == [7, 9]


@pytest.mark.parametrize("labels", [range(300), [i * 7919 % 300 for i in range(300)]])
def test_a_path_takes_few_rounds(spark, labels):
    path = [labels[i] for i in range(300)]
    links, left = spark.createDataFrame(list(zip(path, path[1:])), "a long, b long"), []
    roots = connected_components(links, finish=0, left_each=left).collect()
    assert len(roots) == 300 and len({r.root for r in roots}) == 1
    assert len(left) <= 16  # twice the logarithm


def test_very_dense_subtries(spark):
    rng = np.random.default_rng(5)
    many = np.full(9000, np.uint64(0x0123456789ABCDEF))
    for _ in range(4):
        many = many ^ (np.uint64(1) << rng.integers(0, 64, len(many)).astype(np.uint64))
    many = np.unique(many)
    frame = spark.createDataFrame([(int(x),) for x in many.view(np.int64)], "fp long")
    roots = {r.node: r.root for r in connected_components(simhash.near_links(frame)).collect()}
    want = classes([(i, x) for i, x in enumerate(many)])
    got = [roots.get(x, x) for x in many.view(np.int64).tolist()]
    assert len(set(got)) == len(set(want)) and len(set(zip(got, want))) == len(set(want))
