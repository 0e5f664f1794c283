import zlib

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from vistaloom.llm import packing, queries, tokens


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokens.tokenizer_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


HARD = ["<|endoftext|> a<|startoftext|>b", "İstanbul ﬁne Å Å", "it's we'll go now\x1cok", "a.b,c!? ... ;; 12 345", "漢字かな 한국어 😀😀", "x" * 5000, "word. word, Word; WORD:", " lead\n\ntrail \r\n", "word$$$ Word... don't' it's!? a_b_ x__ rock'n'roll' <|endoftext|>! étés?! 1990's &&& (a)b)"]


def test_encoder_equals_the_library(tokenizer):
    enc = tokens.Encoder(tokens.tokenizer_path())
    for text in HARD + HARD:
        assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == ids_of(tokenizer, text)


def brute_files(rows, tokenizer, end_id):
    start, out = 0, []
    for i, ids, _ in sorted(((i, ids_of(tokenizer, t) + [end_id], xxhash.xxh64_intdigest(t or "", 42) >> 2) for i, t in rows), key=lambda x: (x[0] is not None, x[2] if x[0] is None else x[0], np.array(x[1], "<u2").tobytes())):
        out.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_files(spark, sf_dir, odd, none, tokenizer, monkeypatch):
    want = brute_files([(r.doc_id, r.text) for r in odd.collect()], tokenizer, 2)
    got = [tuple(r) for r in tokens.token_files(odd, tokens.tokenizer_path()).collect()]
    assert sorted(got, key=lambda x: x[1]) == want
    assert tokens.token_files(none, tokens.tokenizer_path()).count() == 0
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bounds = tokens.bounds
    monkeypatch.setattr(tokens, "bounds", lambda df, key, **_: bounds(df, key, rows_each=30))  # several parts
    got = [tuple(r) for r in queries.queries()["op5_token_files"](spark, sf_dir).collect()]
    assert sorted(got, key=lambda x: x[1]) == brute_files([(r.doc_id, r.text) for r in docs.collect()], tokenizer, 2)


def check_packing(rows, out, tokenizer, cap=4096):
    want = []
    for i, text in rows:
        ids = ids_of(tokenizer, text) + [1]
        want += [(str(i), k, s, len(ids[s : s + cap]), crc(ids[s : s + cap])) for k, s in enumerate(range(0, len(ids), cap))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    used = {}
    for r in out:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= cap
    least = -(-sum(r.length for r in out) // cap)
    return len(used), least


def test_packing(spark, sf_dir, odd, none, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n, least = check_packing([(r.doc_id, r.text) for r in docs.collect()], queries.queries()["op10_packing"](spark, sf_dir).collect(), tokenizer)
    assert n <= least + 1
    check_packing([(r.doc_id, r.text) for r in odd.collect()], packing.packed(odd, tokens.tokenizer_path()).collect(), tokenizer)
    assert packing.packed(none, tokens.tokenizer_path()).count() == 0


@pytest.mark.parametrize("low,high,n", [(600, 3000, 20_000), (1, 4097, 5000), (1200, 2500, 3000), (7, 8, 10_000), (4096, 4097, 3)])
def test_plan(low, high, n):
    lengths, counts = np.unique(np.random.default_rng(n).integers(low, high, n), return_counts=True)
    hist = dict(zip(lengths.tolist(), counts.tolist()))
    places, total = packing.plan_packing(hist)
    used, ranks = [0] * total, {}
    for length, first, count, sequence, _ in places:
        assert first == ranks.get(length, 0)
        ranks[length] = first + count
        for s in range(sequence, sequence + count):
            used[s] += length
    assert ranks == hist and max(used) <= 4096 and min(used) > 0
    assert total <= 1.06 * sum(x * c for x, c in hist.items()) / 4096 + 2


def test_other_tokenizers_encode_whole_texts():
    path = tokens.tokenizer_path("byte_bpe_50k.json")
    enc, library = tokens.Encoder(path), Tokenizer.from_file(path)
    assert not enc.by_chunk and tokens.Encoder(tokens.tokenizer_path()).by_chunk
    for text in HARD:
        assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == ids_of(library, text)


def test_an_encoder_forgets(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY", 300_000)
    enc = tokens.Encoder(tokens.tokenizer_path())
    texts = [" ".join(f"w{i * 37 + k} {'long' * (k % 40)}x{i}" for k in range(30)) for i in range(60)]
    for text, ids in zip(texts, enc.encode_all(texts, 2)):
        assert np.frombuffer(ids, enc.dtype).tolist() == ids_of(tokenizer, text)
        assert sum(len(c) + len(i) for c, i in enc.known.items()) < enc.held + 100 <= 400_100
    assert len(enc.known) < 1500 < 60 * 59
