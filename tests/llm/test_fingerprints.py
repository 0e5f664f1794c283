import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from vistaloom.llm import fingerprints as fp
from vistaloom.llm import queries


def shingles(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(docs, out, monkeyed=True):
    # Rows without an id come by a hash of their text.
    place = lambda r: (1, r.doc_id) if r.doc_id is not None else (0, xxhash.xxh64_intdigest(r.text or "", 42) >> 2)
    rows = sorted((place(r) + (r.text or "",) for r in docs.collect()))
    rows = [(bool(has), i if has else 0, text) for has, i, text in rows]
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r) for r in out.collect()), key=lambda x: x[:2])
    assert len(got) == len(rows)
    want = {}
    for k, (has, i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][2]
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        want.setdefault((has, i, len(text), hashlib.sha256(edited.encode()).hexdigest()), []).append((text, edited, following))
    for has, i, r in got:
        text, edited, following = want[(has, i, r.n_chars, r.edited_sha256)].pop()
        for est, true in ((r.near_edited, likeness(text, edited)), (r.near_next, likeness(text, following))):
            assert 0 <= est <= 1 and abs(est - true) < (0.17 if len(shingles(text)) + len(shingles(edited)) + len(shingles(following)) >= fp.K else 1e-9)
        assert abs(r.shingles - len(shingles(text))) <= (0.3 * len(shingles(text)) if len(shingles(text)) >= fp.K else 1e-9)
    return [r for *_, r in got]


def test_query(spark, sf_dir, monkeypatch):
    bounds = fp.bounds
    monkeypatch.setattr(fp, "bounds", lambda df, key, rows_each: bounds(df, key, 17))  # many ranges
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = check(docs, queries.queries()["op1_fingerprints"](spark, sf_dir))
    errors = [abs(r.near_edited - 0.6) for r in rows]
    assert sum(errors) / len(errors) < 0.2
    text = {r.doc_id: r.text for r in docs.collect()}
    by_text = {}
    for r in rows:
        assert by_text.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint


@pytest.mark.parametrize("each", [2, 1000])
def test_odd_rows(odd, none, monkeypatch, each):
    bounds = fp.bounds
    monkeypatch.setattr(fp, "bounds", lambda df, key, rows_each: bounds(df, key, each))
    check(odd, fp.fingerprints(odd))
    assert fp.fingerprints(none).count() == 0
    check(odd.where("doc_id = 1"), fp.fingerprints(odd.where("doc_id = 1")))


def test_sketches_merge(spark):
    parts = spark.createDataFrame([("a", "one two three four five six"), ("a", "x y z"), ("b", None), (None, "q w e r t y"), ("c", " ".join(map(str, range(5000)))), ("c", " ".join(map(str, range(2500, 7500))))], "k string, text string")
    got = {r.k: r.sketch for r in fp.merged_by(parts.withColumn("sketch", fp.sketch(F.col("text"))), "k").collect()}
    assert len(got["a"]) == 3 and got["b"] == [] and len(got[None]) == 2
    whole = spark.createDataFrame([("c", [" ".join(map(str, range(5000))), " ".join(map(str, range(2500, 7500)))])], "k string, t array<string>")
    a, b = fp.sketch(F.col("t")[0]), fp.sketch(F.col("t")[1])
    one = whole.select(fp.merge(a, b).alias("m"), fp.resemblance(a, b).alias("r"), fp.containment(a, b).alias("c"), fp.distinct_shingles(a).alias("n")).first()
    assert one.m == got["c"] and abs(one.r - 1 / 3) < 0.1 and abs(one.c - 0.5) < 0.12 and abs(one.n - 4996) < 1000
