import random
import zlib

import pytest

from vistaloom.llm import langid, queries


def longest_phrases(text, sample):
    """Phrases of a text, each the longest that occurs in the sample (or one symbol)."""
    n = i = 0
    while i < len(text):
        k = i + 1
        while k < len(text) and text[i : k + 1] in sample:
            k += 1
        n, i = n + 1, k
    return n


def test_phrases_equal_brute_force():
    rng = random.Random(5)
    samples = {"x": bytes(rng.choices(b"abc ", k=300)), "y": bytes(rng.choices(b"abcdef ", k=200))}
    parser = langid.Parser(samples)
    texts = [bytes(rng.choices(b"abcdefgz ", k=n)) for n in (1, 2, 30, 511, 512, 513, 2000, 50_000, *[40] * 90, *[700] * 70)] + [b""]
    costs = parser.costs(texts)
    for row, t in zip(costs, texts):
        for cost, automaton, name in zip(row, parser.automata, parser.languages):
            assert cost == pytest.approx(automaton.bits * longest_phrases(t, samples[name]))


def test_marks_stay_with_their_letters():
    assert langid.letters_of("हिन्दी, 12 भाषा! ภาษาไทย_x") == " हिन्दी भाषा ภาษาไทย x ".encode()
    assert langid.letters_of("\u0301 12 _ \u093f") == b"" == langid.letters_of(None)


def test_memory_of_an_automaton():
    rng = random.Random(6)
    words = ["".join(rng.choices("漢字語文中国日本人大小上下左右", k=rng.randint(1, 4))) for _ in range(2000)]
    sample = langid.letters_of(" ".join(rng.choices(words, k=6000)))
    automaton = langid.Automaton(sample)
    assert automaton.owner.nbytes + automaton.next.nbytes < 60 * len(sample)


def test_the_sample_is_of_whole_texts_and_bounded(spark):
    rows = [(i, f"wort{i} " + "katze " * (i % 30), "de") for i in range(3, 2000)] + [(5000, "lang " * 5000, "fr"), (5001, "plus long " * 5000, "fr"), (5002, "mot", None)]
    docs = spark.createDataFrame(rows + rows, "doc_id long, text string, lang string")
    got = langid.learn(docs, documents=20, characters=100)
    assert set(got) == {"de", "fr"}
    whole = {langid.letters_of(t): i for i, t, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    parts = [f" wort{p}".encode() for p in got["de"].decode().split("wort")[1:]]
    assert len(got["de"].split(b" wort")) - 1 == 20 and len(got["de"]) <= 20 * 103
    assert all(langid.letters_of(p.decode()) in {langid.letters_of(t) for _, t, _ in rows} for p in parts)
    assert got["fr"] in whole  # the shortest long text that is not held out, alone


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = queries.queries()["op7_language_id"](spark, sf).collect()
    assert sorted(r.doc_id for r in out) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert len(held) > 150 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_odd_rows(odd, none):
    out = {str(r.doc_id) + str(k): r for k, r in enumerate(langid.languages(odd).collect())}
    texts = odd.collect()
    assert len(out) == len(texts)
    for r, t in zip(langid.languages(odd.coalesce(1)).collect(), odd.coalesce(1).collect()):
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in t.text or "")) and r.doc_id == t.doc_id
    assert langid.languages(none).count() == 0
    assert langid.languages(odd.withColumn("lang", odd.lang.substr(9, 1).cast("string")).where("doc_id = 1").selectExpr("doc_id", "text", "cast(null as string) lang")).first().lang_pred == "und"
    kept = langid.with_language(odd)
    assert kept.columns == odd.columns and kept.count() == sum(any(c.isalpha() for c in t.text or "") for t in texts)


def test_without_labels_only_letterless_texts_go(spark):
    docs = spark.createDataFrame([(1, "plain words", None), (2, None, None), (3, "12 34", None), (4, "\u6f22\u5b57", None)], "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in langid.with_language(docs).collect()) == [1, 4]
