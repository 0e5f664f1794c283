"""Best-fit packing of documents into sequences by linear grouping.

The plan needs only how many pieces there are of each length (at most `cap` numbers): large
lengths, sorted, are cut into groups of equal cardinality and rounded up to their group's largest;
a configuration program over these few sizes is solved by column generation; the real pieces, which
are no longer than the rounded ones, take their places; what is left and all small pieces then go,
longest first, where they fit best. The plan speaks of runs of equal sequences, so its size is
bounded by `cap` and not by the input. Pieces find their place by (length, rank among that length);
ranks are prefix sums over partitions, so nothing is sorted and no length is gathered in a task.
"""

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written
from .tokens import encoder

CAP = 4096
#: (parts, groups) to try: a piece is large if over cap / parts tokens, and large pieces make that
#: many groups. The plan of fewest sequences is taken.
GROUPS = ((2, 12), (4, 8), (4, 24), (4, 48), (8, 48))


def _configurations(sizes: list[int], demand: np.ndarray, cap: int) -> list[tuple[np.ndarray, int]]:
    """Patterns over few sizes with whole multiplicities: the rounded-down optimum of the linear
    configuration program (Gilmore-Gomory column generation; the knapsack is a table by items)."""
    g, s = len(sizes), np.array(sizes)
    basis = np.diag((cap // s).astype(float))
    x = demand / (cap // s)
    for _ in range(40 * g):
        y = np.maximum(np.linalg.solve(basis.T, np.ones(g)), 0)
        best, picks = np.zeros(cap + 1), []
        for _ in range(cap // int(s.min())):
            new, pick = best.copy(), np.full(cap + 1, -1)
            for k in range(g):
                got = best[: cap + 1 - s[k]] + y[k]
                better = got > new[s[k] :] + 1e-12
                new[s[k] :][better] = got[better]
                pick[s[k] :][better] = k
            picks.append(pick)
            best = new
        if best[cap] <= 1 + 1e-9:
            break
        column, room = np.zeros(g), cap
        for pick in reversed(picks):
            if pick[room] >= 0:
                column[pick[room]] += 1
                room -= s[pick[room]]
        u = np.linalg.solve(basis, column)
        ratio = np.where(u > 1e-9, x / np.where(u > 1e-9, u, 1), np.inf)
        out = int(np.argmin(ratio))
        x = np.maximum(x - ratio[out] * u, 0)
        x[out] = ratio[out]
        basis[:, out] = column
    return [(basis[:, k].astype(int), int(x[k] + 1e-6)) for k in range(g) if int(x[k] + 1e-6)]


class _Plan:
    """Runs of sequences; places are (length, first rank, count, first sequence, offset)."""

    def __init__(self, cap: int):
        self.cap, self.n, self.places = cap, 0, []
        self.rank: dict[int, int] = {}
        self.open: dict[int, list[tuple[int, int]]] = {}  # room -> runs (first sequence, count)
        self.rooms: list[int] = []

    def place(self, length: int, count: int, sequence: int, offset: int) -> None:
        first = self.rank.get(length, 0)
        self.places.append((length, first, count, sequence, offset))
        self.rank[length] = first + count

    def leave(self, room: int, sequence: int, count: int) -> None:
        if room and count:
            if room not in self.open:
                bisect.insort(self.rooms, room)
                self.open[room] = []
            self.open[room].append((sequence, count))

    def best_fit(self, length: int, count: int) -> None:
        while count:
            at = bisect.bisect_left(self.rooms, length)
            if at < len(self.rooms):
                room = self.rooms[at]
                sequence, n = self.open[room].pop()
                take = min(n, count)
                if take < n:
                    self.open[room].append((sequence + take, n - take))
                if not self.open[room]:
                    del self.open[room], self.rooms[at]
                self.place(length, take, sequence, self.cap - room)
                self.leave(room - length, sequence, take)
                count -= take
            else:
                each = self.cap // length
                for n, k in ((count // each, each), (min(1, count % each), count % each)):
                    if n:
                        for i in range(k):
                            self.place(length, n, self.n, i * length)
                        self.leave(self.cap - k * length, self.n, n)
                        self.n += n
                count = 0


def _planned(counts: dict[int, int], cap: int, parts: int, groups: int) -> _Plan:
    plan, left = _Plan(cap), dict(counts)
    large = sorted((x for x in counts if x > cap // parts), reverse=True)
    total = sum(counts[x] for x in large)
    groups = min(groups, len(large))
    if groups:
        # Equal-cardinality groups of the large pieces, longest first; a group is a queue of [length, count].
        queues: list[list[list[int]]] = [[] for _ in range(groups)]
        seen = 0
        for x in large:
            n = counts[x]
            while n:
                k = min(groups - 1, seen * groups // total)
                end = -(-(k + 1) * total // groups) if k < groups - 1 else total
                take = min(n, max(1, end - seen))
                queues[k].append([x, take])
                seen, n = seen + take, n - take
        queues = [q for q in queues if q]
        merged: dict[int, list[list[int]]] = {}  # groups of equal rounded size are one
        for q in queues:
            merged.setdefault(q[0][0], []).extend(q)
        sizes = list(merged)
        demand = np.array([sum(n for _, n in q) for q in merged.values()], float)
        queue = [q[::-1] for q in merged.values()]
        for pattern, times in _configurations(sizes, demand, cap):
            slots = [k for k in range(len(sizes)) for _ in range(pattern[k])]
            while times:
                # As many sequences as have equal pieces in every slot; a group that runs out leaves its slots.
                slots = [k for k in slots if queue[k]]
                if not slots:
                    break
                need = {k: slots.count(k) for k in slots}
                run = min([times, *(max(1, queue[k][-1][1] // c) for k, c in need.items())])
                offset, sequence = 0, plan.n
                for k in slots:
                    if not queue[k]:
                        continue
                    length = queue[k][-1][0]
                    plan.place(length, run, sequence, offset)
                    left[length] -= run
                    offset += length
                    queue[k][-1][1] -= run
                    if not queue[k][-1][1]:
                        queue[k].pop()
                plan.n += run
                plan.leave(cap - offset, sequence, run)
                times -= run
    for length in sorted(left, reverse=True):
        if left[length]:
            plan.best_fit(length, left[length])
    return plan


def plan_packing(counts: dict[int, int], cap: int = CAP, groups: tuple[tuple[int, int], ...] = GROUPS) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Places (length, first rank, count, first sequence, offset) and the number of sequences.

    counts: pieces by length, from 1 to cap.
    """
    plans = [_planned(counts, cap, *g) for g in groups]
    best = min(plans, key=lambda p: p.n)
    return sorted(best.places), best.n


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int = 1, cap: int = CAP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, part, nth): nth counts equal lengths within a part."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, part, seen = encoder(tokenizer), TaskContext.get().partitionId(), [0] * (cap + 1)
        for pdf in batches:
            rows = []
            for i, got in zip(pdf["id"], enc.encode_all(pdf["text"])):
                ids = np.append(np.frombuffer(got, enc.dtype), enc.dtype.type(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), cap)):
                    own = ids[start : start + cap]
                    rows.append((i, piece, start, len(own), zlib.crc32(own), part, seen[len(own)]))
                    seen[len(own)] += 1
            out = pd.DataFrame(rows, columns=["id", "piece", "start", "length", "ids_crc32", "part", "nth"])
            yield out.assign(id=out["id"].astype("Int64"))

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(cut, "id long, piece int, start long, length long, ids_crc32 long, part int, nth long")


def packed(docs: DataFrame, tokenizer: str, end_id: int = 1, cap: int = CAP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: (id_col, piece, start, length, ids_crc32, sequence_id, offset).

    A document is its ids and end_id; null text counts as empty (the end id alone). Only documents
    over cap tokens are cut, into pieces of cap tokens; each such piece is a sequence. Repeated
    rows and ids are packed each for itself, a null id stays null. An empty table packs to nothing.
    """
    pieces = written(pieces_of(docs, tokenizer, end_id, cap, id_col, text_col))
    counts = pieces.groupBy("length").count()
    places, _ = plan_packing({r["length"]: r["count"] for r in counts.collect()}, cap)
    # Places by (length, first rank); at most a few for each length, whatever the input.
    length, first, _, sequence, offset = (np.array(c, np.int64) for c in (zip(*places) if places else ((),) * 5))
    start = length * 2**48 + first
    schema = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    @F.pandas_udf(schema)
    def find(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(start, lengths.to_numpy(np.int64) * 2**48 + ranks.to_numpy(np.int64), "right") - 1
        return pd.DataFrame({"sequence_id": sequence[at] + ranks.to_numpy(np.int64) - first[at], "offset": offset[at]})

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = pieces.groupBy("part", "length").count()
    base = base.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    out = pieces.join(base, ["part", "length"]).withColumn("at", find("length", F.col("base") + F.col("nth")))
    return out.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")
