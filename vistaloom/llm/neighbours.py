"""Approximate nearest neighbours by learned partitions.

On a sample of SAMPLE_EACH vectors a part: the neighbour graph is cut into parts of equal size (greedy
moves of highest gain under a capacity), and a small network learns to name a vector's part. There are
about sqrt(n) / 2 parts, however many vectors there are. Every vector is then indexed in its most
probable part; a query goes to its several most probable parts, as many as a held-out piece of the
sample needs for RECALL, and is compared there with every vector, exactly. Small parts share a shelf,
large ones are cut into several; a task is a shelf and a bounded number of queries, and gives each of
them one list of at most k+1. Equal vectors are indexed once: of each, only the k+1 smallest ids can be
among k nearest.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbers, written

#: The sample that the parts are learned from (so many vectors a part, at least SAMPLE), and the held-out
#: queries that set the probes. It grows as the square root of the table: 253,000 of 1e9 vectors.
SAMPLE, SAMPLE_EACH, HELD_OUT = 8192, 16, 512
#: Graph degree, and recall to reach on the held-out queries.
DEGREE, RECALL = 10, 0.96
#: Vectors of a shelf and queries that meet it at a time: what a task holds.
BLOCK = 8192


def parts_for(n: int) -> int:
    """Number of parts of n vectors."""
    return max(1, round(math.sqrt(n) / 2))


def usable(vector: Column) -> Column:
    """Not null, not zero, every component there and finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0), F.lit(False))


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    out = np.empty((len(x), min(degree, len(x) - 1)), np.int64)
    step = max(16, min(512, 40_000_000 // max(1, len(x))))
    for i in range(0, len(x), step):
        score = x[i : i + step] @ x.T
        score[np.arange(len(score)), np.arange(i, i + len(score))] = -np.inf
        out[i : i + 512] = np.argpartition(-score, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """Parts of nearly equal size with few cut edges: halves along main directions, then moves of
    the best gain into parts that have room."""
    n, label = len(x), np.zeros(len(x), np.int64)
    todo = [(np.arange(n), 0, parts)]
    while todo:
        own, first, many = todo.pop()
        if many == 1 or len(own) < 2:
            label[own] = first
            continue
        direction = np.linalg.svd(x[own] - x[own].mean(axis=0), full_matrices=False)[2][0]
        own = own[np.argsort(x[own] @ direction, kind="stable")]
        cut, left = len(own) * (many // 2) // many, many // 2
        todo += [(own[:cut], first, left), (own[cut:], first + left, many - left)]
    room = math.ceil(1.05 * n / parts)
    a, b = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    for _ in range(rounds):
        # Links of every vector with every part that it has any with, and the best of these.
        pair, links = np.unique(np.concatenate([a * parts + label[b], b * parts + label[a]]), return_counts=True)
        of = pair // parts
        order = np.lexsort((pair, -links, of))
        first = order[np.unique(of[order], return_index=True)[1]]
        best, most, own = label.copy(), np.zeros(n, np.int64), np.zeros(n, np.int64)
        best[of[first]], most[of[first]] = pair[first] % parts, links[first]
        same = pair % parts == label[of]
        own[of[same]] = links[same]
        gain = most - own
        size, moved = np.bincount(label, minlength=parts), 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[label[i]] -= 1
                size[best[i]] += 1
                label[i] = best[i]
                moved += 1
        if not moved:
            break
    return label


class Router:
    """Scores of parts for vectors: a linear layer beside one hidden layer, trained by Adam."""

    def __init__(self, x: np.ndarray, label: np.ndarray, parts: int, hidden: int = 64, epochs: int = 25, seed: int = 1):
        rng, d = np.random.default_rng(seed), x.shape[1]
        self.scale = 1 / max(1e-300, float(np.sqrt((x * x).sum(axis=1).mean())))
        self.w = [rng.normal(0, 0.05, (d, parts)), rng.normal(0, 1, (d, hidden)), rng.normal(0, 0.05, (hidden, parts)), np.zeros(parts)]
        m, v, t = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(epochs if parts > 1 else 0):
            order = rng.permutation(len(x))
            for i in range(0, len(x), 256):
                s, y = x[order[i : i + 256]] * self.scale, label[order[i : i + 256]]
                h = np.maximum(s @ self.w[1], 0)
                z = s @ self.w[0] + h @ self.w[2] + self.w[3]
                z = np.exp(z - z.max(axis=1, keepdims=True))
                z /= z.sum(axis=1, keepdims=True)
                z[np.arange(len(y)), y] -= 1
                z /= len(y)
                grads = [s.T @ z, s.T @ ((z @ self.w[2].T) * (h > 0)), h.T @ z, z.sum(axis=0)]
                t += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.w[k] -= 0.01 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-9)

    def scores(self, x: np.ndarray) -> np.ndarray:
        s = x * self.scale
        return s @ self.w[0] + np.maximum(s @ self.w[1], 0) @ self.w[2] + self.w[3]


def learn(sample: np.ndarray, parts: int, k: int, held_out: int, recall: float) -> tuple[Router, int]:
    """The router, and the number of parts that a query visits."""
    held = min(held_out, len(sample) // 8)
    queries, x = sample[:held], sample[held:]
    label = balanced_parts(x, neighbour_graph(x, DEGREE), parts)
    router = Router(x, label, parts)
    own = router.scores(x).argmax(axis=1)
    rank = np.argsort(np.argsort(-router.scores(queries), axis=1), axis=1)
    near = np.argsort(-(queries @ x.T), axis=1)[:, :k]
    at = rank[np.arange(held)[:, None], own[near]]  # probes that a neighbour needs
    for probes in range(1, parts if held else 1):
        if (at < probes).mean() >= recall:
            return router, probes
    return router, parts


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), np.float64).reshape(len(vectors), -1)


def _shelves(counts: dict[int, int], parts: int, block: int) -> tuple[list[int], list[int], int]:
    """First shelf and number of shelves of every part, and how many shelves there are: parts of over
    block / 2 vectors have shelves of their own, small ones share one in order of their numbers."""
    first, many, shelf, room = [0] * parts, [1] * parts, -1, 0
    for p in range(parts):
        n = counts.get(p, 0)
        if 2 * n > block:
            many[p] = -(-n // block)
            first[p], shelf, room = shelf + 1, shelf + many[p], 0
        else:
            if n > room or shelf < 0:
                shelf, room = shelf + 1, block
            first[p], room = shelf, room - n
    return first, many, shelf + 1


def _nearest_of(q: pd.DataFrame, x: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest of every query among the vectors of its parts; equal scores: smaller rep first."""
    x = x.sort_values(["part", "rep"])
    reps, vectors, part = x["rep"].to_numpy(), _matrix(x["v"]), x["part"].to_numpy()
    asks = _matrix(q["v"])
    who = np.repeat(np.arange(len(q)), q["parts"].map(len))
    where = np.concatenate(q["parts"].tolist())
    out = []
    for p in np.unique(part).tolist():
        own = who[where == p]
        lo, hi = np.searchsorted(part, [p, p + 1])
        for i in range(0, len(own), 512):
            some = own[i : i + 512]
            score = asks[some] @ vectors[lo:hi].T
            least = np.partition(score, -k, axis=1)[:, -k] if hi - lo > k else np.full(len(some), -np.inf)
            row, col = np.nonzero(score >= least[:, None])  # with all that tie for the last place
            out.append((some[row], score[row, col], reps[lo:hi][col]))
    if not out:
        return pd.DataFrame({"q": [], "rep": [], "score": []})
    of, score, rep = map(np.concatenate, zip(*out))
    order = np.lexsort((rep, -score, of))
    of, score, rep = of[order], score[order], rep[order]
    rank = np.arange(len(of)) - np.searchsorted(of, of)
    best = rank < k
    return pd.DataFrame({"q": q["rep"].to_numpy()[of[best]], "rep": rep[best], "score": score[best]})


def nearest(table: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id_col, score): the k nearest found of every query, by inner product.

    Rows where is_query holds are queries; candidates are all rows of another id. Scores are in
    double precision on the vectors as they are; ranks follow score, then the smaller id. Null ids
    and vectors that are not usable, or not of the table's most frequent length (the shorter of
    equally frequent ones), take no part; repeated rows count once. An empty table gives an empty
    result; other columns are not read but by is_query.

    Equal vectors are told by 96 bits of two hashes. Vectors travel once to their class, once to their
    shelf (as often as the shelf's queries fill blocks) and, of queries, to each shelf that holds one of
    their parts; everything else is ids and scores.
    """
    spark, kind = table.sparkSession, table.schema[vector_col].dataType.simpleString()
    v = F.col(f"`{vector_col}`")
    # -0.0 is 0.0 to a hash of doubles, as it is to an inner product.
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")).where(F.col("id").isNotNull() & usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score double")
    rows = rows.where(F.size("v") == lengths[0]["d"]).withColumn("h", F.struct(F.xxhash64("v").alias("a"), F.hash("v").alias("b")))
    # Classes of equal vectors, named by their smallest id, and their k+1 smallest ids.
    ids = rows.select("h", "id").distinct().withColumn("n", F.row_number().over(Window.partitionBy("h").orderBy("id"))).where(F.col("n") <= k + 1)
    members = ids.groupBy("h").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids"))  # k+1 at most
    classes = written(rows.groupBy("h").agg(F.min_by("v", "id").alias("v"), F.min("id").alias("rep"), F.max("asks").alias("asks")).select("rep", "v", "asks"))
    n = classes.count()
    parts = parts_for(n)
    sample = classes.select("v").orderBy(F.xxhash64("rep")).limit(max(SAMPLE, SAMPLE_EACH * parts) + HELD_OUT).toPandas()["v"]
    router, probes = learn(_matrix(sample), parts, k, HELD_OUT, RECALL)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                score = router.scores(_matrix(pdf["v"]))
                top = np.argsort(-score, axis=1, kind="stable")[:, :probes].astype(np.int32)
                asks = pdf["asks"].to_numpy(bool)
                yield pdf.assign(part=score.argmax(axis=1), probed=[t if a else None for t, a in zip(top, asks)])

    placed = written(classes.mapInPandas(index, f"rep long, v {kind}, asks boolean, part int, probed array<int>"))
    counts = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}  # a number a part
    first, many, shelves = _shelves(counts, parts, BLOCK)
    at = lambda values, p: F.get(numbers(values), p.cast("int"))
    piece = lambda p: F.pmod(F.xxhash64("rep"), at(many, p))
    # A query goes once to each shelf that has any of its parts.
    shelves_of = F.array_distinct(F.flatten(F.transform("probed", lambda p: F.sequence(at(first, p), at(first, p) + at(many, p) - 1))))
    asked = placed.where("asks").select("rep", "v", "probed", F.explode(shelves_of).alias("shelf"))
    there = F.filter("probed", lambda p: (at(first, p) <= F.col("shelf")) & (F.col("shelf") < at(first, p) + at(many, p)))
    asked = asked.select("rep", "v", "shelf", there.alias("parts"))
    loads = {r["shelf"]: r["count"] for r in asked.groupBy("shelf").count().collect()}  # a number a shelf
    turns = [max(1, -(-loads.get(s, 0) // BLOCK)) for s in range(shelves)]
    asked = asked.withColumn("turn", F.pmod(F.xxhash64("rep"), at(turns, F.col("shelf"))))
    stored = placed.select("rep", "v", "part", (at(first, F.col("part")) + piece(F.col("part"))).alias("shelf"))
    stored = stored.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), at(turns, F.col("shelf")) - 1)))

    def compare(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"q": [], "rep": [], "score": []})
        return _nearest_of(q, x, k + 1)

    key = ["shelf", "turn"]
    found = asked.groupBy(*key).cogroup(stored.groupBy(*key)).applyInPandas(compare, "q long, rep long, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "rep")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).select("q", "rep", "score")
    found = found.join(members.select("rep", "ids"), "rep").select("q", "score", F.explode("ids").alias("id"))
    by_id = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    found = found.withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= k + 1)
    # Queries of a class share its list; each leaves itself out.
    lists = found.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("near"))  # k+1 at most
    queries = rows.where("asks").select("h", "id").distinct().join(members.select("h", F.col("rep").alias("q")), "h").select("q", "id")
    near = F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k)
    out = queries.join(lists, "q").select(F.col("id").alias("query_id"), F.posexplode(near).alias("rank", "x"))
    return out.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.id").alias(id_col), F.col("x.score").alias("score"))
