import re
import sys

import corpus_pipeline
import pytest
from tokenizers import Tokenizer

from vistaloom.llm import tokens
from vistaloom.llm.common import written

from .test_mixing import brute_targets
from .test_simhash import brute_fingerprint, classes
from .test_tokens_packing import check_packing


def words(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def stages(spark, docs):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], "")))
    return [x.collect() for x in out], out


def check(spark, docs):
    (raw, known, one, safe, mix, packed), frames = stages(spark, docs)
    assert all(f.columns == docs.columns for f in frames[1:-1])
    # Language: exactly what has letters stays.
    assert sorted(map(str, known)) == sorted(str(r) for r in raw if any(c.isalpha() for c in r.text or ""))
    # Near duplicates: one of each class of the stage's input, of the smallest id.
    prints = [(r.doc_id, brute_fingerprint(r.text)) for r in known]
    component = classes(prints)
    assert len(one) == len({(c, brute_fingerprint(r.text) if c is None else None) for c, r in zip(component, known)})
    assert {r.doc_id for r in one if r.doc_id is not None} <= set(component)
    # Pseudonyms: rows and their other columns stay, private strings do not.
    text = {r.doc_id: r.text for r in one}
    assert sorted(str(r.doc_id) for r in safe) == sorted(str(r.doc_id) for r in one)
    private = re.compile(r"\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\S)[^\s@]+@\S+\.\w+")
    for r in safe:
        assert r.n_chars == len(r.text)
        assert not any(p in r.text for p in private.findall(text[r.doc_id]))
    # Mix: each source takes its target.
    sizes = {}
    for r in safe:
        sizes[r.source] = sizes.get(r.source, 0) + words(r.text)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    taken = dict.fromkeys(order, 0)
    for r in mix:
        taken[r.source] += words(r.text)
    for source, target in zip(order, brute_targets([sizes[s] for s in order])):
        assert abs(taken[source] - target) <= 1
    # Packing: every copy of the mix, whole.
    tokenizer = Tokenizer.from_file(tokens.tokenizer_path())
    n, least = check_packing([(r.doc_id, r.text) for r in mix], packed, tokenizer)
    return n, least


def test_stages(spark, sf_dir):
    n, least = check(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert n <= least + 1
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_odd_rows(spark, odd, none):
    check(spark, odd)
    assert all(not x for x in stages(spark, none)[0])
