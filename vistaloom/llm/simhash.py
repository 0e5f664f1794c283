"""SimHash near-duplicate classes through a binary trie self-join.

Fingerprints are 64 bits. Two fingerprints at `budget` = 3 or fewer differing bits agree on at
least one of four 16-bit blocks, so each distinct fingerprint is sent, rotated, to the four
subtries named by its blocks, and every link lies within one subtrie. In a subtrie the trie is
the sorted array itself: pairs of nodes (ranges of the array) descend together bit by bit, carry
the differing bits so far, and are dropped once these exceed the budget. Subtries of many
fingerprints are first divided again, by four blocks of the bits that are left, and those of many
once more, by the same argument.
Equal fingerprints are one class from the start; a task gives a spanning forest of its links, not
all pairs, which leaves every component as it is.
"""

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import row_hash, written
from .components import connected_components

BUDGET = 3
#: Subtries of more distinct fingerprints than this are divided by a block of the bits that are left.
DENSE = 1024
#: Bits that the divisions one after another quarter, and the number of the first group of each.
FREE, FIRST = (64, 48, 36), (0, 4, 20)
#: Node pairs that descend at a time, and pairs of fingerprints compared at a time: memory bounds.
FRONT = 100_000
LEAF = 64


def fingerprint_of(text: str | None) -> int:
    """64-bit SimHash, as a signed integer, of the 3-word shingles of a whole text."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    shingles = map(b" ".join, zip(words, words[1:], words[2:])) if len(words) >= 3 else [b" ".join(words)]
    n = max(1, len(words) - 2)
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(s, 42) for s in shingles), "<u8", n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 65536):
        ones += np.unpackbits(h[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


@F.pandas_udf(T.LongType())
def _fingerprint(text: pd.Series) -> pd.Series:
    return pd.Series([fingerprint_of(t) for t in text], dtype="int64")


def fingerprint(text: Column) -> Column:
    """Signed long column with the SimHash of a text column; null and wordless texts give 0."""
    return _fingerprint(text)


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _rotated(fp: Column, bits: int) -> Column:
    return fp if bits == 0 else F.shiftleft(fp, bits).bitwiseOR(F.shiftrightunsigned(fp, 64 - bits))


def _low_rotated(key: Column, low: int, bits: int) -> Column:
    """The upper bits stay, the lower `low` bits turn left."""
    if bits == 0:
        return key
    rest = key.bitwiseAND(F.lit(2**low - 1))
    turned = F.shiftleft(rest, bits).bitwiseAND(F.lit(2**low - 1)).bitwiseOR(F.shiftrightunsigned(rest, low - bits))
    return key.bitwiseAND(F.lit(-(2**low))).bitwiseOR(turned)


def _unrotate(key: np.ndarray, grp: np.ndarray) -> np.ndarray:
    """Fingerprints (uint64) from keys: grp names the block of every division, LEVELS from the first."""
    key = key.copy()
    for level in range(len(FREE) - 1, -1, -1):
        low, deep = np.uint64(FREE[level]), grp >= FIRST[level]
        block = grp - FIRST[level]
        for deeper in range(level + 1, len(FREE)):  # the digit of this division
            block = np.where(grp >= FIRST[deeper], (grp - FIRST[deeper]) // 4 ** (deeper - level), block)
        turn = np.where(deep, block % 4, 0).astype(np.uint64) * np.uint64(FREE[level] // 4)
        mask = np.uint64(2 ** FREE[level] - 1)
        rest = key & mask
        key = (key & ~mask) | (np.where(turn == 0, rest, (rest >> turn) | (rest << ((low - turn) % np.uint64(64)))) & mask)
    return key


def _prefix(grp: np.ndarray, key: np.ndarray) -> np.ndarray:
    """What names a key's subtrie within its group: the bits that all its divisions hold equal."""
    free = np.select([grp >= f for f in FIRST[::-1]], [3 * x // 4 for x in FREE[::-1]]).astype(np.uint64)
    return key >> free


def _compare(keys: np.ndarray, l1, h1, l2, h2) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between ranges [l1,h1) and [l2,h2) (the same range: within it), by XOR."""
    n1, n2 = h1 - l1, h2 - l2
    sizes = n1 * n2
    ends = np.cumsum(sizes)
    for start in range(0, len(sizes), max(1, 4 * FRONT // LEAF)):
        s = slice(start, start + max(1, 4 * FRONT // LEAF))
        part = sizes[s]
        which = np.repeat(np.arange(len(part)), part)
        k = np.arange(part.sum()) - np.repeat(ends[s] - part - (ends[start - 1] if start else 0), part)
        i = l1[s][which] + k // n2[s][which]
        j = l2[s][which] + k % n2[s][which]
        ok = (i < j) & (np.bitwise_count(keys[i] ^ keys[j]) <= BUDGET)
        yield i[ok], j[ok]


def trie_links(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, top: int = 48) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) that link the sorted distinct uint64 keys of subtries [lo, hi).

    Keys of a subtrie agree on the bits above `top`. Within one subtrie the links given join the
    same fingerprints as all links of at most BUDGET differing bits.
    """
    many = hi - lo > 1
    lo, hi = lo[many].astype(np.int64), hi[many].astype(np.int64)
    stack = [(top - 1, lo, hi, lo, hi, np.zeros(len(lo), np.int64))]
    while stack:
        bit, l1, h1, l2, h2, err = stack.pop()
        if not len(l1):
            continue
        if len(l1) > FRONT:
            half = len(l1) // 2
            stack.append((bit, *(x[half:] for x in (l1, h1, l2, h2, err))))
            stack.append((bit, *(x[:half] for x in (l1, h1, l2, h2, err))))
            continue
        # All that is left fits the budget: every pair links, and a star joins them.
        full = err + bit + 1 <= BUDGET
        if full.any():
            a1, b1, a2, b2 = l1[full], h1[full], l2[full], h2[full]
            for first, start, end in ((a1, a2, b2), (a2, a1, b1)):
                n = end - start
                i = np.repeat(first, n)
                j = np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield i[i != j], j[i != j]
        leaf = ~full & ((h1 - l1) * (h2 - l2) <= LEAF)
        if leaf.any():
            yield from _compare(keys, l1[leaf], h1[leaf], l2[leaf], h2[leaf])
        go = ~full & ~leaf
        if not go.any():
            continue
        l1, h1, l2, h2, err = (x[go] for x in (l1, h1, l2, h2, err))
        m1, m2 = _split(keys, l1, h1, bit), _split(keys, l2, h2, bit)
        same = l1 == l2
        kids = [(l1, m1, l2, m2, err), (m1, h1, m2, h2, err), (l1, m1, m2, h2, err + 1)]
        kids.append(tuple(x[~same] for x in (m1, h1, l2, m2, err + 1)))
        out = [np.concatenate([k[c] for k in kids]) for c in range(5)]
        alive = (out[0] < out[1]) & (out[2] < out[3]) & (out[4] <= BUDGET)
        stack.append((bit - 1, *(x[alive] for x in out)))


def _split(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """First index in [lo, hi) whose key has the bit: keys there agree above it. Binary search."""
    lo, hi, mask = lo.copy(), hi.copy(), np.uint64(1 << bit)
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        one = np.zeros(len(lo), bool)
        one[open_] = (keys[mid[open_]] & mask) != 0
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)
    return lo


class _Forest:
    """Union-find over the keys of a block; `up` points every key at its root between calls."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> tuple[list[int], list[int]]:
        """Joins the trees of i[k] and j[k] for every k; returns links that did so."""
        i, j = self.up[i], self.up[j]
        apart = i != j
        if not apart.any():
            return [], []
        pairs = np.unique(np.stack([np.minimum(i, j), np.maximum(i, j)], axis=1)[apart], axis=0)
        up, a, b = self.up, [], []
        for x, y in pairs.tolist():
            while up[x] != x:
                x = up[x]
            while up[y] != y:
                y = up[y]
            if x != y:
                up[max(x, y)] = min(x, y)
                a.append(int(x))
                b.append(int(y))
        while (up[up] != up).any():
            up[:] = up[up]
        return a, b


def _links(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by (grp, key); a subtrie that a batch may have cut waits for the next."""

    def solve(grp: np.ndarray, key: np.ndarray) -> pd.DataFrame:
        prefix = _prefix(grp, key)
        cut = np.flatnonzero((grp[1:] != grp[:-1]) | (prefix[1:] != prefix[:-1])) + 1
        lo, hi = np.concatenate([[0], cut]), np.concatenate([cut, [len(key)]])
        forest, a, b = _Forest(len(key)), [], []
        for i, j in trie_links(key, lo, hi):
            x, y = forest.join(i, j)
            a += x
            b += y
        fp = _unrotate(key, grp).view("<i8")
        return pd.DataFrame({"a": fp[a], "b": fp[b]})

    held: list[tuple[np.ndarray, np.ndarray]] = []  # of one subtrie, the last one so far
    for pdf in rows:
        grp, key = pdf["grp"].to_numpy(np.int64), pdf["key"].to_numpy(np.int64).view(np.uint64)
        if not len(key):
            continue
        prefix = _prefix(grp, key)
        other = np.flatnonzero((grp != grp[-1]) | (prefix != prefix[-1]))
        last = int(other[-1]) + 1 if len(other) else 0
        if held and (last or held[0][0][0] != grp[0] or _prefix(*held[0])[0] != prefix[0]):
            held.append((grp[:last], key[:last]))
            yield solve(*map(np.concatenate, zip(*held)))
            held = []
        elif last:
            yield solve(grp[:last], key[:last])
        held.append((grp[last:], key[last:]))
    if held:
        yield solve(*map(np.concatenate, zip(*held)))


def near_links(fps: DataFrame, column: str = "fp") -> DataFrame:
    """(a, b): links that join the distinct long fingerprints of a table into their components."""
    rows, done = fps.select(F.lit(0).alias("grp"), F.col(column).alias("key")), []
    for level, (low, first) in enumerate(zip(FREE, FIRST)):
        turned = lambda t: _low_rotated(F.col("key"), low, t * low // 4) if level else _rotated(F.col("key"), t * low // 4)  # noqa: B023, E731
        own = F.col("grp") - (FIRST[level - 1] if level else 0)
        rows = rows.select(F.explode(F.array(*[F.struct((first + own * 4 + t).cast("int").alias("grp"), turned(t).alias("key")) for t in range(4)])).alias("x"))
        rows = rows.select("x.grp", "x.key", F.shiftrightunsigned("x.key", 3 * low // 4).alias("top"))
        if level + 1 == len(FREE):
            done.append(rows)
            break
        dense = rows.groupBy("grp", "top").count().where(F.col("count") > DENSE).select("grp", "top")
        done.append(rows.join(dense, ["grp", "top"], "left_anti"))
        rows = rows.join(dense, ["grp", "top"], "left_semi").select("grp", "key")
    tries = functools.reduce(DataFrame.unionByName, done).repartition("grp", "top")
    unsigned = F.col("key").bitwiseXOR(F.lit(-(2**63)))
    return tries.sortWithinPartitions("grp", unsigned).select("grp", "key").mapInPandas(_links, "a long, b long").distinct()


def _members(fps: DataFrame) -> DataFrame:
    """(fp, root) for the distinct fingerprints of a table with a column fp."""
    distinct = fps.select("fp").distinct()
    roots = connected_components(near_links(distinct))
    return distinct.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id_col, fingerprint, component_id, n_links).

    component_id is the smallest id reachable over links of at most BUDGET differing bits, the
    row's own included; n_links counts the spanning links of its class. Null text counts as
    empty, and all wordless texts (fingerprint 0) are one class. Rows with equal ids stay as
    they are; a null id takes part, but names a class only if all of its ids are null (then null).
    Other columns are not read.
    """
    prints = written(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col)).alias("fp")))
    classes = prints.groupBy("fp").agg(F.min("id").alias("least"))
    member = classes.join(_members(classes), "fp")
    whole = member.groupBy("root").agg(F.min("least").alias("component_id"), (F.count("*") - 1).alias("n_links"))
    member = member.select("fp", "root").join(whole, "root").select("fp", "component_id", "n_links")
    return prints.join(member, "fp").select(F.col("id").alias(id_col), hex16(F.col("fp")).alias("fingerprint"), "component_id", "n_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each near-duplicate class: of smallest id, null ids last, then by the hash of
    the text, then by that of the whole row.

    So rows that differ in any column leave one in a defined way, and wholly equal rows leave one of
    them. Null, empty and wordless texts are one class, long texts are read whole, an empty table
    stays empty. Columns are those of docs, whatever their names.
    """
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    names = ["no_id", "id", "text_hash", "row_hash"]
    rank = [id_.isNull().alias("no_id"), F.coalesce(id_.cast("long"), F.lit(0)).alias("id"), F.xxhash64(text).alias("text_hash"), row_hash(docs).alias("row_hash")]
    prints = written(docs.select(*rank, fingerprint(text).alias("fp")))
    rows = prints.groupBy("fp").agg(F.min(F.struct(*names)).alias("first"))
    kept = rows.join(_members(rows), "fp").groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *rank)
    return whole.join(kept, names, "left_semi").dropDuplicates(names).select("row.*")
