"""Substring deduplication by hashing lines and the content-defined units they fall into.

A line is cut after words whose hash (with the word before) is the least among the words around, so
that a passage is cut alike wherever it stands, in a line of its own or inside another. Units are normalised (case,
punctuation), their digests grouped over all documents, and the earliest document of a digest keeps
it. Elsewhere, and at later places of the same document, a unit is a repeat. Runs of repeats are
removed if they are long enough or make up whole lines; the spans removed are given in the offsets
of the original text.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: A unit ends with the least hash among so many words on either side (or with its line), so it has
#: more words than this unless the line ends or the words repeat.
REACH = 3
#: Words that a run inside a line must have to go, and words that a wholly repeated line must have. Short
#: lines recur in documents that are otherwise their own (greetings, bylines): line_words=1 takes them too.
RUN_WORDS, LINE_WORDS = 20, 20
LAST = 2**63 - 1

_MARKS = re.compile(r"[^\w]+")
_SPACES = np.array([chr(c).isspace() for c in range(0x3100)])
_BASE = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Hash of a word without case and punctuation; remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(_MARKS.sub("", word.lower()) or word)
        return out


_hashes = _Hashes()
_powers = np.array([pow(int(_BASE), k, 2**64) for k in range(4096)], np.uint64)


class Cut:
    """Units of a text: first and end word of each, digests, and words' code point offsets."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        space = _SPACES[np.minimum(codes, len(_SPACES) - 1)]
        edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)  # of words
        n = len(self.start)
        h = np.fromiter(map(_hashes.__getitem__, text.split()), np.uint64, n)
        lines = np.cumsum(codes == 10)
        self.line = lines[self.start] if n else np.zeros(0, np.int64)
        self.size = len(codes)
        self.breaks = np.flatnonzero(codes == 10)
        last = np.ones(n, bool)
        if n:
            last[:-1] = self.line[1:] != self.line[:-1]
        mixed = h * np.uint64(31)
        mixed[1:] += h[:-1]
        mixed = mixed * _BASE >> np.uint64(1)
        around = np.full(n + 2 * REACH, np.uint64(2**64 - 1))
        around[REACH : n + REACH] = mixed
        picked = np.ones(n, bool)
        for k in range(1, REACH + 1):
            picked &= (mixed <= around[REACH - k : n + REACH - k]) & (mixed <= around[REACH + k : n + REACH + k])
        ends = np.flatnonzero(last | picked) + 1
        self.first = np.concatenate([[0], ends[:-1]]).astype(np.int64) if n else np.zeros(0, np.int64)
        self.stop = ends
        place = np.arange(n) - np.repeat(self.first, self.stop - self.first) if n else np.zeros(0, np.int64)
        powers = _powers if not n or place.max() < len(_powers) else np.array([pow(int(_BASE), k, 2**64) for k in range(int(place.max()) + 1)], np.uint64)
        self.digest = np.add.reduceat(h * powers[place], self.first) if n else np.zeros(0, np.uint64)
        self.digest = self.digest * _BASE ^ (self.stop - self.first).astype(np.uint64)


def removed_spans(cut: Cut, foreign: np.ndarray, run_words: int = RUN_WORDS, line_words: int = LINE_WORDS) -> list[tuple[int, int]]:
    """Spans to remove. foreign: units whose digest an earlier document has (any place of it)."""
    n = len(cut.digest)
    if not n:
        return []
    _, first, group = np.unique(cut.digest, return_index=True, return_inverse=True)
    elsewhere = np.zeros(len(first), bool)
    elsewhere[group[foreign]] = True
    repeat = elsewhere[group] | (first[group] != np.arange(n))
    words, line = cut.stop - cut.first, cut.line[cut.first]
    # Whole lines: all units of a line repeat.
    starts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    whole = np.repeat(np.logical_and.reduceat(repeat, starts) & (np.add.reduceat(words, starts) >= line_words), np.diff(np.append(starts, n)))
    # Runs of repeats, over line ends too.
    edge = np.diff(np.concatenate([[0], repeat.astype(np.int8), [0]]))
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = np.concatenate([[0], np.cumsum(words)])
    long = total[hi] - total[lo] >= run_words
    gone = whole.copy()
    for a, b in zip(lo[long].tolist(), hi[long].tolist()):
        gone[a:b] = True
    edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
    out = []
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
        start, end = int(cut.start[cut.first[a]]), int(cut.end[cut.stop[b - 1] - 1])
        left = a > 0 and line[a - 1] == line[a]
        right = b < n and line[b] == line[b - 1]
        if not left and not right:  # whole lines go with their line end
            end = int(cut.start[cut.first[b]]) if b < n else cut.size
        elif left and right:  # the space after goes with a run inside a line
            end = int(cut.start[cut.first[b]])
        out.append((start, end))
    return out


def _keys(docs: DataFrame, id_col: str, text_col: str) -> list:
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("__key"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("__hash")]


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_words: int = RUN_WORDS, line_words: int = LINE_WORDS) -> DataFrame:
    """(id_col, text, n_removed, removed): every row with its text after removal.

    removed is array<struct<start, end>> in code points of the original text, ascending; n_removed
    is their total. The document of the smallest id keeps a unit; null ids come last, by their texts'
    hash. Other documents of equal ids do not displace each other, nor do repeated rows. Null text
    stays null with nothing removed; empty and very long texts are cut like others, and an empty table
    stays empty. Rows stay as many as they were; other columns are not read. A line of under line_words
    words, and a run of under run_words inside lines, stays.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), *_keys(docs, id_col, text_col))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            some, size = [], 0
            for key, h, text in zip(pdf["__key"], pdf["__hash"], pdf["__text"]):
                digest, first, count = np.unique(Cut(text).digest, return_index=True, return_counts=True)
                some.append((np.full(len(first), key, np.int64), np.full(len(first), h, np.int64), digest.view(np.int64), first.astype(np.int32), count > 1))
                size += len(first)
                if size > 200_000:
                    yield pd.DataFrame(dict(zip(("key", "hash", "digest", "unit", "again"), map(np.concatenate, zip(*some)))))
                    some, size = [], 0
            if some:
                yield pd.DataFrame(dict(zip(("key", "hash", "digest", "unit", "again"), map(np.concatenate, zip(*some)))))

    units = written(rows.where("__text is not null").mapInPandas(cut, "key long, hash long, digest long, unit int, again boolean"))
    no_id = F.when(F.col("key") == LAST, F.col("hash"))
    first = units.groupBy("digest").agg(F.min("key").alias("first"), F.max("key").alias("last"), F.min(no_id).alias("least"), F.max(no_id).alias("most"))
    first = first.where((F.col("first") < F.col("last")) | ((F.col("first") == LAST) & (F.col("least") < F.col("most")))).select("digest", "first", "least")
    foreign = units.join(first, "digest").where((F.col("first") < F.col("key")) | ((F.col("first") == LAST) & (F.col("least") < F.col("hash")))).select("key", "hash", "unit")
    again = units.where("again").select("key", "hash", F.lit(None).cast("int").alias("unit")).distinct()
    foreign = foreign.unionByName(again).groupBy("key", "hash").agg(F.collect_set("unit").alias("units"))  # of one text; nulls are not collected
    marked = rows.join(foreign, (rows["__key"] == foreign["key"]) & (rows["__hash"] == foreign["hash"]), "left").select("__id", "__text", "units")

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, spans = [], []
            for text, marks in zip(pdf["__text"], pdf["units"]):
                found = [] if marks is None else removed_spans(Cut(text), np.array(marks, np.int64), run_words, line_words)
                if found:
                    at = [0, *(x for s in found for x in s), len(text)]
                    text = "".join(text[a:b] for a, b in zip(at[::2], at[1::2]))
                texts.append(text)
                spans.append([{"start": a, "end": b} for a, b in found])
            yield pd.DataFrame({"__id": pdf["__id"], "text": texts, "removed": spans})

    kind = docs.schema[id_col].dataType.simpleString()
    out = marked.mapInPandas(remove, f"__id {kind}, text string, removed array<struct<start:int,end:int>>")
    total = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(F.col("__id").alias(id_col), "text", total.alias("n_removed"), "removed")
