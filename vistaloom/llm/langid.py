"""Language identification by cross-parsing entropy.

For every language a suffix automaton of a bounded sample of labelled text recognises all of its
substrings. A text is parsed left to right into the longest phrases that occur in the sample; the
fewer phrases it needs, weighed by the bits that name one (log2 of the sample's length), the closer
it is to the language. A text is one parse from its first byte to its last. Texts are parsed many
at a time, longest first: a step moves all of them by one byte; the last few, longer than the rest,
go on one by one. An automaton is a double array: the transition of a state by a byte stands at the
state's number plus the byte, beside the state that owns it, so a language takes memory by its
transitions (about 50 bytes a byte of its sample) and not by states times symbols.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The bounded sample: so many whole labelled texts of each language, of at most so many characters.
#: Where a language has too few of these, its shortest ones, DOCUMENTS x CHARACTERS in all (one at least).
DOCUMENTS = 96
CHARACTERS = 800
#: Texts moved at a time and bytes of each laid out at once (memory bounds), and below how many texts
#: each goes on by itself.
WIDTH = 4096
STRETCH = 512
FEW = 64
UNKNOWN = "und"

#: A word is letters with their combining marks.
_GAP = regex.compile(r"[^\p{L}\p{M}]+")


def letters_of(text: str | None) -> bytes:
    """Lower-case words between single spaces, as UTF-8; empty if there is no letter."""
    words = _GAP.sub(" ", (text or "").lower()).strip()
    return f" {words} ".encode() if any(map(str.isalpha, words)) else b""


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the start."""
    go: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return go


class Automaton:
    """A suffix automaton as a double array. A state is its place: its transition by byte c stands at
    place + c if `owner` there is the place. Places are drawn at random until nothing collides."""

    def __init__(self, sample: bytes):
        go = suffix_automaton(sample)
        state = np.repeat(np.arange(1, len(go)), [len(out) for out in go[1:]])
        byte = np.array([c for out in go[1:] for c in out], np.int64)
        target = np.array([t for out in go[1:] for t in out.values()], np.int64)
        size = 2 * len(state) + len(go) + 1024
        rng, many = np.random.default_rng(1), np.bincount(state, minlength=len(go))
        place, used, taken = np.zeros(len(go), np.int64), np.zeros(size + 256, bool), np.zeros(size, bool)
        taken[0] = True  # place 0 is the start, which has no transitions of its own
        for low, high in ((8, 257), (4, 8), (2, 4), (1, 2), (0, 1)):
            left = np.flatnonzero((many >= low) & (many < high) & (np.arange(len(go)) > 0))
            while len(left):
                at = np.zeros(len(go), np.int64)
                at[left] = rng.integers(1, size, len(left))
                good = np.zeros(len(go), bool)
                good[left[np.unique(at[left], return_index=True)[1]]] = True
                good &= ~taken[at]
                own = np.flatnonzero(good[state])
                slot = at[state[own]] + byte[own]
                bad = np.ones(len(own), bool)
                bad[np.unique(slot, return_index=True)[1]] = False
                good[state[own[bad | used[slot]]]] = False
                own = own[good[state[own]]]
                used[at[state[own]] + byte[own]] = True
                placed = left[good[left]]
                place[placed], taken[at[placed]] = at[placed], True
                left = left[~good[left]]
        self.owner, self.next = np.full(size + 256, -1, np.int32), np.zeros(size + 256, np.int32)
        self.owner[place[state] + byte], self.next[place[state] + byte] = place[state], place[target]
        self.start = np.zeros(256, np.int32)
        for c, t in go[0].items():
            self.start[c] = place[t]
        self.bits = math.log2(max(2, len(sample)))

    def move(self, steps: np.ndarray, active: np.ndarray, row: np.ndarray, phrases: np.ndarray) -> None:
        """Moves the first active[t] texts by steps[t], for every t; row and phrases are theirs."""
        for step, n in zip(steps, active.tolist()):
            at, now = step[:n], row[:n]
            slot = now + at
            on = self.owner.take(slot) == now
            phrases[:n] += ~on
            row[:n] = np.where(on, self.next.take(slot), self.start.take(at))

    def finish(self, rest: bytes, row: int) -> int:
        """Phrases that begin in the rest of a text whose parse has come to row."""
        owner, next_, start, n = memoryview(self.owner), memoryview(self.next), memoryview(self.start), 0
        for c in rest:
            if owner[row + c] == row:
                row = next_[row + c]
            else:
                n += 1
                row = start[c]
        return n


class Parser:
    """Counts phrases of many texts against one automaton per language."""

    def __init__(self, samples: dict[str, bytes]):
        self.languages = sorted(samples)
        self.automata = [Automaton(samples[name]) for name in self.languages]

    def costs(self, texts: list[bytes]) -> np.ndarray:
        """Bits of every text (row) in every language (column)."""
        out = np.zeros((len(texts), len(self.languages)))
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        for k in range(0, len(order), WIDTH):
            some = order[k : k + WIDTH]
            out[some] = self._costs([texts[i] for i in some])
        return out

    def _costs(self, texts: list[bytes]) -> np.ndarray:
        """Of at most WIDTH texts, longest first."""
        size = np.array([len(t) for t in texts])
        rows = [np.zeros(len(texts), np.int32) for _ in self.automata]
        phrases = [np.zeros(len(texts), np.int64) for _ in self.automata]
        at = 0
        while (n := int((size > at).sum())) >= FEW:
            flat = np.frombuffer(b"".join(t[at : at + STRETCH].ljust(STRETCH, b"\0") for t in texts[:n]), np.uint8).reshape(n, STRETCH)
            width = min(STRETCH, int(size[0]) - at)
            steps = np.ascontiguousarray(flat[:, :width].T).astype(np.int32)
            active = n - np.searchsorted(size[:n][::-1], np.arange(at, at + width), "right")
            for automaton, row, count in zip(self.automata, rows, phrases):
                automaton.move(steps, active, row, count)
            at += STRETCH
        for i in range(n):
            for automaton, row, count in zip(self.automata, rows, phrases):
                count[i] += automaton.finish(texts[i][at:], int(row[i]))
        return np.stack([count * automaton.bits for automaton, count in zip(self.automata, phrases)], axis=1) if self.automata else np.zeros((len(texts), 0))


def predict(parser: Parser, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """The language of fewest bits and its share of all languages' likelihoods (2 to the minus bits).

    Texts without letters, and all texts if nothing was learned, are UNKNOWN with score 0. Of equal
    languages the first by code point wins.
    """
    plain = [letters_of(t) for t in texts]
    if not parser.languages:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    costs = parser.costs(plain)
    best = costs.argmin(axis=1)
    share = 1 / np.exp2(np.maximum(costs.min(axis=1, keepdims=True) - costs, -1000)).sum(axis=1)
    return [parser.languages[b] if p else UNKNOWN for b, p in zip(best, plain)], [float(s) if p else 0.0 for s, p in zip(share, plain)]


def held_out(id_: Column) -> Column:
    """Documents that are never learned from: crc32 of the id as text is 2 modulo 4; null: empty."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", documents: int = DOCUMENTS, characters: int = CHARACTERS) -> dict[str, bytes]:
    """A bounded sample of labelled text by language: at most `documents` different texts of each, whole.

    Texts of at most `characters` come first, by a hash of the text, then longer ones, shortest first,
    as long as those before have under documents x characters. So a language's sample is bounded by
    that, or is one text. Held-out rows, null labels and texts without letters are not taken. Choice is
    by language, hash and length alone; then the chosen texts are fetched.
    """
    text, lang = F.col(f"`{text_col}`"), F.col(f"`{lang_col}`")
    rows = docs.where(~held_out(F.col(f"`{id_col}`")) & lang.isNotNull() & text.rlike(r"\p{L}"))
    rows = rows.select(lang.cast("string").alias("lang"), F.xxhash64(F.lit("sample"), text).alias("h"), text.alias("text"))
    size = F.char_length("text")
    least = rows.select("lang", "h", size.alias("size"), F.when(size <= characters, 0).otherwise(size).alias("over"))
    for key in (("lang", F.pmod("h", F.lit(8))), ("lang",)):  # salted first: a language may hold most rows
        # Equal texts have equal rank: dense_rank counts different ones.
        least = least.withColumn("n", F.dense_rank().over(Window.partitionBy(*key).orderBy("over", "h"))).where(F.col("n") <= documents)
        least = least.dropDuplicates(["lang", "h"])
    before = Window.partitionBy("lang").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    least = least.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).where(F.col("before") < documents * characters).select("lang", "h", "n")
    chosen = F.broadcast(least)  # documents rows a language at most
    pieces: dict[str, dict[int, bytes]] = {}
    for r in rows.join(chosen, ["lang", "h"]).dropDuplicates(["lang", "h"]).select("lang", "n", "text").collect():
        pieces.setdefault(r["lang"], {})[r["n"]] = letters_of(r["text"])
    texts = {name: b"".join(p for _, p in sorted(some.items())) for name, some in pieces.items()}
    return {name: t for name, t in texts.items() if t}


_parsers: dict[int, Parser] = {}


def _parser(samples: dict[str, bytes]) -> Parser:
    """One parser a sample and Python worker."""
    key = hash(tuple(sorted(samples.items())))
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = Parser(samples)
    return _parsers[key]


def identified(samples: dict[str, bytes], text_col: str = "text") -> Column:
    """Column struct<lang_pred, score> of a text column."""

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def go(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = _parser(samples)
        for some in texts:
            names, scores = predict(parser, list(some))
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return go(F.col(text_col))


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id_col, held_out, lang_pred, score) per input row, learned from docs' own labels.

    Only the text enters a prediction. Null and letterless texts are "und" with score 0; repeated
    rows get equal answers; without any labelled text every row is "und". Other columns are not read.
    """
    found = identified(learn(docs, id_col, text_col, lang_col), text_col)
    rows = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), found.alias("__found"))
    return rows.select(id_col, "held_out", "__found.lang_pred", "__found.score")


def with_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that have a language; columns are those of docs, whatever their names.

    Without any labelled text those with letters. Null, empty and letterless texts go; long texts are
    parsed whole; repeated rows stay or go together; an empty table stays empty."""
    samples = learn(docs, id_col, text_col, lang_col)
    if not samples:
        return docs.where(F.col(text_col).rlike(r"\p{L}"))
    found = identified(samples, text_col)
    return docs.where(found["lang_pred"] != UNKNOWN)
