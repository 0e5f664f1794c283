"""Points from depth: back-projection, fusion, nearest distances, outliers, boxes around points."""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g


def back_projected(pixels: DataFrame, fx: float = 50.0, fy: float = 50.0, cx: float = 32.0, cy: float = 24.0) -> DataFrame:
    """pixels(u, v, d) with camera-frame columns p_x, p_y, p_z. Depth 0 gives the origin."""
    c = [F.lit(float(x)) for x in (fx, fy, cx, cy)]
    p = g.back_project(F.col("u"), F.col("v"), F.col("d"), *c)
    return pixels.select("*", *[v.alias(f"p_{k}") for v, k in zip(p, "xyz")])


def _share(df: DataFrame, keys: list[str], value: Column, share: float) -> DataFrame:
    """Mean of the smallest max(1, floor(share*n)) values of each key.

    Values are counted by key first, so a hot key shuffles its distinct values, not its rows: equal
    values stand together in the order, and the last of them is cut to what is wanted.
    """
    h = df.select(*keys, value.alias("__d")).groupBy(*keys, "__d").agg(F.count("*").alias("__c"))
    all_, up = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("__d").rowsBetween(Window.unboundedPreceding, -1)
    h = h.withColumn("__n", F.sum("__c").over(all_)).withColumn("__b", F.coalesce(F.sum("__c").over(up), F.lit(0)))
    k = F.greatest(F.lit(1), F.floor(F.lit(share) * F.col("__n")))
    take = F.least("__c", k - F.col("__b"))
    return h.where(F.col("__b") < k).groupBy(*keys).agg(F.first("__n").alias("n"), F.sum(take).alias("k"), (F.sum(F.col("__d") * take) / F.sum(take)).alias("value"))


def front_depth(pixels: DataFrame, keys: list[str], share: float = 0.1) -> DataFrame:
    """Depth of an object's front: mean of its shallowest tenth of valid (positive) depths."""
    return _share(pixels.where("d > 0"), keys, F.col("d"), share).withColumnRenamed("value", "depth")


def closest_mean(points: DataFrame, keys: list[str], share: float = 0.2) -> DataFrame:
    """Mean distance from the camera of the nearest fifth of an object's points."""
    return _share(points, keys, g.norm(*g.vec("p")), share).withColumnRenamed("value", "distance")


def depth_order(depths: DataFrame, frame: str = "frame_id", obj: str = "obj_idx") -> DataFrame:
    """Rank of objects from near to far, ties by index."""
    w = Window.partitionBy(frame).orderBy(F.round("depth", 6), obj)
    return depths.withColumn("rank", F.row_number().over(w))


#: Pairs of points that a join may make for one key; beyond it blocks of points are compared in numpy.
JOINED = 100_000


def _leaves(p: np.ndarray, most: int = 128) -> list[np.ndarray]:
    """Row numbers of p in blocks of near points: halves along the longest side."""
    todo, out = [np.arange(len(p))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= most:
            out.append(rows)
            continue
        axis = int(np.ptp(p[rows], axis=0).argmax())
        rows = rows[np.argpartition(p[rows, axis], len(rows) // 2)]
        todo += [rows[: len(rows) // 2], rows[len(rows) // 2 :]]
    return out


def _boxes(p: np.ndarray, leaves: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([p[r].min(axis=0) for r in leaves]), np.array([p[r].max(axis=0) for r in leaves])


def _gaps(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Squared distances from a box to boxes: no points of theirs are nearer."""
    return (np.maximum(0, np.maximum(lows - high, low - highs)) ** 2).sum(axis=-1)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return sum((a[:, None, c] - b[None, :, c]) ** 2 for c in range(a.shape[1]))


def nearest_of_clouds(a: np.ndarray, b: np.ndarray) -> float:
    """Smallest distance between two clouds: pairs of blocks in the order of their gap, until the gap is
    no smaller than the best distance."""
    la, lb = _leaves(a), _leaves(b)
    (low_a, high_a), (low_b, high_b) = _boxes(a, la), _boxes(b, lb)
    best = np.inf
    # Blocks of a by their gap to the nearest block of b: a row of gaps at a time, so memory is linear.
    near = np.array([_gaps(x, y, low_b, high_b).min() for x, y in zip(low_a, high_a)])
    for i in np.argsort(near):
        if near[i] >= best:
            break
        gaps = _gaps(low_a[i], high_a[i], low_b, high_b)
        for j in np.argsort(gaps):
            if gaps[j] >= best:
                break
            best = min(best, float(_squares(a[la[i]], b[lb[j]]).min()))
    return float(np.sqrt(best))


def neighbour_means(p: np.ndarray, k: int) -> np.ndarray:
    """Mean distance of every point to its k nearest points, itself the first: each block meets the other
    blocks in the order of their gap, until no point of it can have a nearer neighbour."""
    k = min(k, len(p))
    leaves, out = _leaves(p), np.empty(len(p))
    low, high = _boxes(p, leaves)
    for i, rows in enumerate(leaves):
        gaps = _gaps(low[i], high[i], low, high)
        best = np.empty((len(rows), 0))
        for j in np.argsort(gaps, kind="stable"):
            if best.shape[1] == k and gaps[j] >= best.max():
                break
            best = np.concatenate([best, _squares(p[rows], p[leaves[j]])], axis=1)
            if best.shape[1] > k:
                best = np.partition(best, k - 1, axis=1)[:, :k]
        out[rows] = np.sqrt(best).mean(axis=1)
    return out


def nearest_distance(a: DataFrame, b: DataFrame, keys: list[str], joined: int = JOINED) -> DataFrame:
    """Smallest distance between two point sets for each key; repeated points count once.

    Small sets meet in a join whose minimum is combined before the shuffle. Keys whose sets would make
    more than `joined` pairs go to a kernel that compares blocks of near points only; it holds the two
    clouds of one key, which images bound. Both ways are exact.
    """
    cols = ["p_x", "p_y", "p_z"]
    others = [f"q{c[1:]}" for c in cols]
    x = a.select(*keys, *cols).distinct()
    y = b.select(*[F.col(k).alias(k) for k in keys], *[F.col(c).alias(q) for c, q in zip(cols, others)]).distinct()
    n = x.groupBy(*keys).agg(F.count("*").alias("__n")).join(y.groupBy(*keys).agg(F.count("*").alias("__m")), keys)
    large = n.where(F.col("__n").cast("double") * F.col("__m") > joined).select(*keys)
    d = g.distance(g.vec("p"), g.vec("q"))
    some = x.join(large, keys, "left_anti").join(y, keys).groupBy(*keys).agg(F.min(d).alias("distance"))

    def kernel(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(p) or not len(q):
            return pd.DataFrame(columns=[*keys, "distance"])
        return p[keys].iloc[:1].assign(distance=nearest_of_clouds(p[cols].to_numpy(np.float64), q[others].to_numpy(np.float64)))

    schema = ", ".join(f"`{k}` {a.schema[k].dataType.simpleString()}" for k in keys) + ", distance double"
    rest = x.join(large, keys, "left_semi").groupBy(*keys).cogroup(y.join(large, keys, "left_semi").groupBy(*keys)).applyInPandas(kernel, schema)
    return some.unionByName(rest)


def range_join(a: DataFrame, b: DataFrame, radius: float, keys: list[str] = (), prefix: str = "q") -> DataFrame:
    """Pairs of points of a (p_*) and b (p_* renamed prefix_*) within a radius: cells of its size and
    the 27 around, an equality join and the exact test. Cells are a little wider than the radius, so
    that rounding cannot put two near points two cells apart."""
    keys = list(keys)
    cell = lambda c: F.floor(F.col(c) / (radius * 1.000001)).cast("long")
    left = a.select("*", *[cell(f"p_{k}").alias(f"__{k}") for k in "xyz"])
    right = b.select(*[F.col(c).alias(prefix + c[1:] if c.startswith("p_") else c) for c in b.columns])
    shift = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip("xyz", (i, j, k))]) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)])).alias("__s")
    right = right.select("*", shift).select("*", *[(cell(f"{prefix}_{k}") + F.col(f"__s.{k}")).alias(f"__{k}") for k in "xyz"]).drop("__s")
    d = g.distance(g.vec("p"), g.vec(prefix))
    return left.join(right, [*keys, "__x", "__y", "__z"]).where(F.round(d, 9) <= radius).withColumn("distance", d).drop("__x", "__y", "__z")


#: Candidates that the grid holds at once, and that the lists of a run of keys may have.
AT_ONCE, LISTED = 2_000_000, 20_000_000


class Grid:
    """Points in cells a little wider than a radius, for all points within it of others."""

    def __init__(self, q: np.ndarray, radius: float):
        self.q, self.radius = q, radius
        c = self._cells(q)
        self.low, high = c.min(axis=0), c.max(axis=0)
        self.wide = high - self.low + 1
        x, y, z = (c - self.low).T
        self.rows, rank = np.unique(z * self.wide[1] + y, return_inverse=True)
        code = rank * self.wide[0] + x
        self.order = np.argsort(code, kind="stable")
        self.code = code[self.order]

    def _cells(self, p: np.ndarray) -> np.ndarray:
        return np.floor(p / (self.radius * 1.000001)).astype(np.int64)

    def ranges(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From and to, in `order`, of the nine rows of three cells around each point."""
        x, y, z = (self._cells(p) - self.low).T
        wx, wy, wz = self.wide
        left, right = np.clip(x - 1, 0, wx), np.clip(x + 1, -1, wx - 1)
        lo, hi = np.zeros((2, len(p), 9), np.int64)
        for n, (dz, dy) in enumerate((dz, dy) for dz in (-1, 0, 1) for dy in (-1, 0, 1)):
            zz, yy = z + dz, y + dy
            row = zz * wy + yy
            at = np.minimum(np.searchsorted(self.rows, row), len(self.rows) - 1)
            some = (zz >= 0) & (zz < wz) & (yy >= 0) & (yy < wy) & (self.rows[at] == row) & (left <= right)
            lo[some, n] = np.searchsorted(self.code, (at * wx + left)[some])
            hi[some, n] = np.searchsorted(self.code, (at * wx + right)[some], "right")
        return lo, hi

    def near(self, p: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of p, ascending; rows of q) of the pairs within the radius, some at a time."""
        lo, hi = (r.ravel() for r in self.ranges(p))
        n = hi - lo
        done, ends = 0, np.cumsum(n)
        while done < len(n):
            upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + AT_ONCE, "right")))
            i = np.repeat(np.arange(done, upto) // 9, n[done:upto])
            j = self.order[_spans(lo[done:upto], n[done:upto])]
            a, b = p[i].T, self.q[j].T
            d = np.sqrt(sum((u - v) * (u - v) for u, v in zip(a, b)))
            some = np.floor(d * 1e9 + 0.5) / 1e9 <= self.radius  # rounded to nine digits, as range_join does
            yield i[some], j[some]
            done = upto


def _spans(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ... (n of them) for each of the runs, one after the other."""
    return np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)


def _places(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct points, number of each point's)."""
    code = np.zeros(len(p), np.int64)
    for c in p.T:
        own, values = pd.factorize(c)
        code = pd.factorize(code * len(values) + own)[0]
    first = np.full(code.max() + 1, len(p))
    np.minimum.at(first, code, np.arange(len(p)))
    return p[first], code


def near_counts(p: np.ndarray, owner: np.ndarray, q: np.ndarray, other: np.ndarray) -> Callable[[float], Iterator[tuple[int, np.ndarray, np.ndarray]]]:
    """By radius: for each owner (0, 1, ... ascending) of points p, the others of points q that have some
    within the radius, and how many pairs of points.

    Points at one place are one for the search: an owner's points give each place of q a number, and each
    place adds its number to the others that stand there.
    """
    at_p, own = _places(p)
    at_q, theirs = _places(q)
    both = np.unique(owner * np.int64(len(at_p)) + own)  # repeated points of an owner count once
    owner, own = both // len(at_p), both % len(at_p)
    both = np.unique(theirs * np.int64(other.max() + 1) + other)
    stood, others = both // (other.max() + 1), both % (other.max() + 1)
    begin = np.searchsorted(stood, np.arange(len(at_q) + 1))
    starts = np.searchsorted(owner, np.arange(owner.max() + 2))

    def go(radius: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        grid = Grid(at_q, radius)
        lo, hi = grid.ranges(at_p)
        work = np.concatenate([[0], np.cumsum((hi - lo).sum(axis=1)[own])])
        k, last = 0, len(starts) - 1
        while k < last:
            upto = max(k + 1, int(np.searchsorted(work[starts], work[starts[k]] + LISTED, "right")) - 1)
            used = np.unique(own[starts[k] : starts[upto]])
            if upto > k + 1:
                found = list(grid.near(at_p[used]))
                i, j = (np.concatenate(x) for x in zip(*found))
                rows = np.searchsorted(i, np.arange(len(used) + 1))
            for o in range(k, upto):
                mine = own[starts[o] : starts[o + 1]]
                weight = np.zeros(len(at_q), np.int64)
                if upto > k + 1:
                    r = np.searchsorted(used, mine)
                    weight += np.bincount(j[_spans(rows[r], rows[r + 1] - rows[r])], minlength=len(at_q))
                else:
                    for _, some in grid.near(at_p[mine]):
                        weight += np.bincount(some, minlength=len(at_q))
                place = np.flatnonzero(weight)
                n = begin[place + 1] - begin[place]
                count = np.bincount(others[_spans(begin[place], n)], np.repeat(weight[place], n)).astype(np.int64)
                some = np.flatnonzero(count)
                yield o, some, count[some]
            k = upto

    return go


def range_counts(points: DataFrame, key: str, radius: float, block: int = 2_000_000) -> DataFrame:
    """(a_key, b_key, n): pairs of keys, the smaller first, and how many pairs of their points (p_*) are within
    the radius of each other. Repeated points of a key count once; others than finite ones have no neighbours.

    Keys are dealt over blocks of about `block` points, and each two blocks meet in one task, which has all
    points of both: a pair of keys is counted in one place, and no pair of points is shuffled. A key's points
    stay together; a depth image bounds them.
    """
    total = points.count()
    blocks = max(-(-total // block), min(4, -(-total // 100_000)), 1)
    finite = F.lit(True)
    for c in "xyz":
        finite = finite & (F.abs(f"p_{c}") < float("inf"))
    # Sorted by depth and in columns, a key's points take little room in the shuffle.
    lists = points.where(finite & F.col(key).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_set(F.struct("p_z", "p_y", "p_x"))).alias("p"))
    lists = lists.select(F.col(key).alias("key"), F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("block"), *[F.col(f"p.p_{c}").alias(c) for c in "xyz"])
    i, j = F.least("block", "other"), F.greatest("block", "other")
    each = lists.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")).withColumn("task", (j * (j + 1) / 2).cast("int") + i)

    def points_of(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        p = np.stack([np.concatenate(rows[c].to_list()) for c in "xyz"], axis=1)
        return p + 0.0, np.repeat(np.arange(len(rows)), [len(x) for x in rows["x"]])

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = [b for b in batches if len(b)]
        if not every:
            return
        for _, rows in pd.concat(every).sort_values("key").groupby("task"):
            here = [r for _, r in rows.groupby("block")]
            (a, b), same = (here[0], here[-1]), len(here) == 1
            if same and (rows["block"] != rows["other"]).any():
                continue  # the other block has no keys
            keys, those, out, n = a["key"].to_numpy(), b["key"].to_numpy(), [], 0
            for o, others, count in near_counts(*points_of(a), *points_of(b))(radius):
                k, found = keys[o], those[others]
                if same:
                    found, count = found[found > k], count[found > k]
                out.append((np.minimum(k, found), np.maximum(k, found), count))
                n += len(found)
                if n > 500_000:
                    yield pd.DataFrame(dict(zip(("a_key", "b_key", "n"), map(np.concatenate, zip(*out)))))
                    out, n = [], 0
            if out:
                yield pd.DataFrame(dict(zip(("a_key", "b_key", "n"), map(np.concatenate, zip(*out)))))

    kind = points.schema[key].dataType.simpleString()
    return each.repartitionById(blocks * (blocks + 1) // 2, F.col("task")).mapInPandas(go, f"a_key {kind}, b_key {kind}, n long")


def extents(points: DataFrame, keys: list[str]) -> DataFrame:
    """Axis-aligned extent of each key's points."""
    return points.groupBy(*keys).agg(*[(F.max(f"p_{c}") - F.min(f"p_{c}")).alias(f"size_{c}") for c in "xyz"])


def inliers(points: DataFrame, keys: list[str], neighbours: int = 10, ratio: float = 2.0) -> DataFrame:
    """Statistical outlier removal: points whose mean distance to their nearest `neighbours` points
    (the point itself is the first) is no more than mean + ratio * standard deviation of those.

    A group is one object's cloud, which a depth image bounds; a point meets only the blocks of points
    that may hold one of its nearest (neighbour_means), not the whole cloud.
    """

    def keep(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf[["p_x", "p_y", "p_z"]].to_numpy(np.float64)
        mean = neighbour_means(p, neighbours)
        limit = mean.mean() + ratio * (mean.std(ddof=1) if len(p) > 1 else 0)
        return pdf[mean <= limit + 1e-12]

    return points.groupBy(*keys).applyInPandas(keep, points.schema)


def fused(points: DataFrame, keys: list[str], view: str, least: int = 2) -> DataFrame:
    """Objects with points in at least `least` views."""
    return points.groupBy(*keys).agg(F.countDistinct(view).alias("n_views"), F.count("*").alias("n_points")).where(F.col("n_views") >= least)


def contained(points: DataFrame, boxes: DataFrame, key: str, scale: float = 0.9) -> DataFrame:
    """Points within each scaled oriented box of their key: (key, node_id, n_points, n_inside)."""
    b = boxes.select("*", *g.trig())
    p = points.join(b, key)
    inside = g.in_box(g.vec("p"), g.vec("c"), g.vec("l"), g.box_axes(), scale)
    return p.groupBy(key, "node_id").agg(F.count("*").alias("n_points"), F.sum(inside.cast("long")).alias("n_inside"))


def box_of_mask(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """2-D box of an object's pixels."""
    return pixels.groupBy(*keys).agg(F.min("u").alias("x1"), F.min("v").alias("y1"), F.max("u").alias("x2"), F.max("v").alias("y2"))


def first_pixel_label(pixels: DataFrame, keys: list[str], label: str, width: int) -> DataFrame:
    """Label at an object's first pixel in row order."""
    return pixels.groupBy(*keys).agg(F.min_by(label, F.col("v") * width + F.col("u")).alias(label))


def planar_depth(pixels: DataFrame, fx: float, cx: float, cy: float, scale: float = 1000.0) -> DataFrame:
    """Distance along the ray (dist) to depth along the axis, in whole units of 1/scale; NaN gives 0."""
    ray = g.norm(F.col("u") - cx, F.col("v") - cy, F.lit(float(fx)))
    d = F.nanvl(F.col("dist") * fx / ray, F.lit(0.0))
    return pixels.withColumn("depth", (d * scale).cast("int"))


def resized(pixels: DataFrame, width: int, height: int, to_width: int, to_height: int) -> DataFrame:
    """A mask's pixels (u, v) brought to another size: a pixel of the new mask takes the nearest old one,
    floor((u + 0.5) * width / to_width)."""
    take = lambda c, old, new: F.filter(F.sequence(F.floor(F.col(c) * new / old).cast("int") - 1, F.ceil((F.col(c) + 1) * new / old).cast("int")), lambda t: (t >= 0) & (t < new) & (F.floor((t + 0.5) * old / new) == F.col(c)))
    rest = [c for c in pixels.columns if c not in ("u", "v")]
    out = pixels.select(*rest, "v", F.explode(take("u", width, to_width).cast("array<bigint>")).alias("u"))
    return out.select(*rest, "u", F.explode(take("v", height, to_height).cast("array<bigint>")).alias("v"))


def fused_clouds(pixels: DataFrame, views: DataFrame, keys: list[str], view: str = "view_idx", neighbours: int = 10, ratio: float = 2.0, least: int = 2) -> DataFrame:
    """World points (keys, view, p_*) of objects that have a cloud in at least `least` views.

    pixels (keys, view, u, v, d) are an object's mask over the depth map; views give camera, pose and
    intrinsics (fx, fy, cx, cy). Each view's cloud is rid of outliers by itself before clouds are counted.
    """
    on = [k for k in (*keys, view) if k in views.columns]
    p = pixels.where("d > 0").join(views, on)
    c = g.back_project(F.col("u"), F.col("v"), F.col("d"), F.col("fx"), F.col("fy"), F.col("cx"), F.col("cy"))
    w = g.to_world(g.camera(), c)
    cloud = p.select(*keys, view, *[x.alias(f"p_{k}") for k, x in zip("xyz", w)])
    cloud = inliers(cloud, [*keys, view], neighbours, ratio)
    enough = fused(cloud, keys, view, least).select(*keys)
    return cloud.join(enough, keys, "left_semi")
