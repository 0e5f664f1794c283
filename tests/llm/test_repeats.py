import random
import re

import numpy as np
import pytest
import xxhash

from vistaloom.llm import queries, repeats


def norm(word):
    return re.sub(r"[^\w]+", "", word.lower()) or word


def plain_units(text):
    """(first word, end word, line) of every unit, word by word."""
    words = [(m.start(), m.group()) for m in re.finditer(r"\S+", text)]
    assert [w for _, w in words] == text.split()
    h = [xxhash.xxh64_intdigest(norm(w)) for _, w in words]
    mixed = [(h[i] * 31 + (h[i - 1] if i else 0)) * 0x9E3779B97F4A7C15 % 2**64 >> 1 for i in range(len(h))]
    line = [text.count("\n", 0, at) for at, _ in words]
    out, first = [], 0
    for i in range(len(words)):
        least = all(mixed[i] <= m for m in mixed[max(0, i - repeats.REACH) : i + repeats.REACH + 1])
        if least or i + 1 == len(words) or line[i + 1] != line[i]:
            out.append((first, i + 1, line[i]))
            first = i + 1
    return out


def rank(i, text):
    h = xxhash.xxh64_intdigest(text, 42)
    return (1, h - 2**64 if h >= 2**63 else h) if i is None else (0, i)


def brute(docs, run_words=repeats.RUN_WORDS, line_words=repeats.LINE_WORDS):
    """Text after removal by (id, text), from units found one by one."""
    seen, cuts = {}, {}
    for i, text in docs:
        if text is not None:
            w = [norm(x) for x in text.split()]
            cut = plain_units(text)
            cuts[i, text] = cut, [tuple(w[a:b]) for a, b, _ in cut]
            for u in cuts[i, text][1]:
                seen[u] = min(seen.get(u, (2, 0)), rank(i, text))
    out = {}
    for (i, text), (cut, units) in cuts.items():
        own = {u: k for k, u in reversed(list(enumerate(units)))}
        repeat = [seen[u] < rank(i, text) or own[u] < k for k, u in enumerate(units)]
        words = [len(u) for u in units]
        line = [x for _, _, x in cut]
        lines = {}
        for r, n, x in zip(repeat, words, line):
            lines[x] = (lines.get(x, (True, 0))[0] and r, lines.get(x, (True, 0))[1] + n)
        gone = [lines[x][0] and lines[x][1] >= line_words for x in line]
        k = 0
        while k < len(units):
            e = k
            while e < len(units) and repeat[e]:
                e += 1
            if sum(words[k:e]) >= run_words:
                gone[k:e] = [True] * (e - k)
            k = max(e, k + 1)
        split = text.split()
        out[i, text] = [w for k, (a, b, _) in enumerate(cut) if not gone[k] for w in split[a:b]]
    return out


def check(df, out, **sizes):
    want = brute([(r.doc_id, r.text) for r in df.collect()], **sizes)
    texts = {}
    for r in df.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    rows = out.collect()
    assert len(rows) == df.count()
    n = 0
    for r in rows:
        for text in texts[r.doc_id]:
            if text is None:
                ok = r.text is None and not r.removed
            else:
                at = [0, *(x for s in r.removed for x in (s.start, s.end)), len(text)]
                ok = r.text == "".join(text[a:b] for a, b in zip(at[::2], at[1::2])) and r.text.split() == want[r.doc_id, text]
            if ok:
                texts[r.doc_id].remove(text)
                break
        else:
            raise AssertionError(r)
        assert r.n_removed == sum(s.end - s.start for s in r.removed)
        n += r.n_removed > 0
    return n


def test_query(spark, sf_dir):
    assert check(spark.read.parquet(f"{sf_dir}/documents.parquet"), queries.queries()["op3_repeats"](spark, sf_dir)) > 0


def test_odd_rows(odd, none):
    check(odd, repeats.without_repeats(odd))
    assert check(odd, repeats.without_repeats(odd, run_words=3, line_words=1), run_words=3, line_words=1) >= 2
    assert repeats.without_repeats(none).count() == 0


def test_passages_inside_lines_are_caught_and_clean_texts_stay(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(3000)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    passages = [prose(rng.randint(51, 90)) for _ in range(20)]
    rows = [(i, f"{prose(30)} {passages[i % 20].capitalize()}. {prose(25)}\n{prose(12)}") for i in range(200)]
    rows += [(1000 + i, "\n".join(prose(rng.randint(3, 40)) for _ in range(4))) for i in range(200)]
    out = {r.doc_id: r for r in repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    left = 0
    for i, text in rows:
        if i < 20 or i >= 1000:
            assert out[i].text == text
        else:
            passage = passages[i % 20].split()
            kept = set(zip(*[out[i].text.lower().split()[k:] for k in range(25)]))
            left += any(tuple(passage[k : k + 25]) in kept for k in range(len(passage) - 24))
    assert left <= 3  # of 180


@pytest.mark.parametrize("text", ["", " ", "one", "a\nb\n\nc", "x " * 9000, " em　space\n"])
def test_cuts_cover_every_word(text):
    c = repeats.Cut(text)
    w = text.split()
    assert [text[a:b] for a, b in zip(c.start, c.end)] == w
    assert np.concatenate([np.arange(a, b) for a, b in zip(c.first, c.stop)] or [np.arange(0)]).tolist() == list(range(len(w)))


def test_rows_without_an_id_are_ranked_by_their_texts(spark):
    line = "one line of some words that all of these share " * 3
    rows = [(None, f"{line}\nown {k}") for k in range(5)] + [(3, "other words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert check(docs, repeats.without_repeats(docs)) == 4


def test_short_lines_go_if_asked_for(spark):
    rows = [(i, f"Hello there\nsomething of {i} alone {i * 7} here") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert check(docs, repeats.without_repeats(docs)) == 0
    assert check(docs, repeats.without_repeats(docs, line_words=1), line_words=1) == 5
