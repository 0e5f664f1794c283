"""Seeded, repeatable choices: no engine randomness, so retries and reruns agree."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g


def key(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def fraction(seed: int, *columns: str) -> Column:
    """Uniform in [0, 1)."""
    return F.pmod(key(seed, *columns), F.lit(1 << 30)) / float(1 << 30)


def sample(df: DataFrame, by: list[str], n: int, seed: int, *unique: str) -> DataFrame:
    """n rows of each group, in hash order."""
    w = Window.partitionBy(*by).orderBy(key(seed, *unique), *unique)
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


def choice(values: list, seed: int, *columns: str, weights: list[float] | None = None) -> Column:
    """One of the values, by hash; weights need not add up to 1."""
    weights = weights or [1.0] * len(values)
    f, out = fraction(seed, *columns), F.lit(values[-1])
    for i in reversed(range(len(values) - 1)):
        out = F.when(f < sum(weights[: i + 1]) / sum(weights), F.lit(values[i])).otherwise(out)
    return out


def shuffled(options: Column, seed: int, *columns: str) -> Column:
    """A list in hash order."""
    pairs = F.transform(options, lambda o, i: F.struct(F.xxhash64(F.lit(seed), *columns, i).alias("k"), i.alias("i"), o.alias("o")))
    return F.transform(F.array_sort(pairs), lambda p: p["o"])


def letter(options: Column, correct: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in "ABCDEFGH"]), F.array_position(options, correct).cast("int"))


def wrong_counts(count: Column, n: int = 3, spread: int = 5, seed: int = 0) -> Column:
    """n distinct numbers other than count, within spread of it and not below 0."""
    near = F.filter(F.sequence(F.greatest(F.lit(0), count - spread), count + spread), lambda x: x != count)
    by_hash = F.transform(near, lambda x: F.struct(F.xxhash64(F.lit(seed), count, x).alias("k"), x.alias("x")))
    return F.transform(F.slice(F.array_sort(by_hash), 1, n), lambda s: s["x"])


def round_robin(df: DataFrame, anchor: list[str], n: int, seed: int, *unique: str, pair: tuple[str, str] | None = None) -> DataFrame:
    """n rows in all, a first one of every anchor, then a second one of every anchor, and so on.

    Within an anchor the rows take turns too, if pair names two columns: a first row of every unordered
    pair of their values, then a second one of every pair. Rows beyond the n-th of an anchor or pair
    cannot be among n and go before anything is sorted as a whole.
    """
    if pair:
        low, high = F.least(*pair), F.greatest(*pair)
        df = df.withColumn("__pair", F.struct(low.alias("a"), high.alias("b")))
        same = Window.partitionBy(*anchor, "__pair").orderBy(key(seed, *unique), *unique)
        df = df.withColumn("__r", F.row_number().over(same)).where(F.col("__r") <= n)
        w = Window.partitionBy(*anchor).orderBy("__r", F.xxhash64(F.lit(seed), "__pair.a", "__pair.b"), "__pair")
    else:
        w = Window.partitionBy(*anchor).orderBy(key(seed, *unique), *unique)
    turn = df.withColumn("__t", F.row_number().over(w)).where(F.col("__t") <= n)
    return turn.orderBy("__t", key(seed, *anchor), *anchor).limit(n).drop("__t", "__r", "__pair")


def diverse_views(views: DataFrame, n: int, min_rotation: float, min_translation: float, seed: int = 0) -> DataFrame:
    """(scene_id, view_idx): greedily, in hash order, views that differ from all chosen before; scenes
    that cannot fill n go. A fold over each scene's views, which are few (subsample_views)."""
    names = [f"{a}_{c}" for a in ("pos", "right", "down", "fwd") for c in "xyz"]
    item = F.struct(key(seed, "scene_id", "view_idx").alias("k"), F.col("view_idx"), *names)
    scenes = views.groupBy("scene_id").agg(F.sort_array(F.collect_list(item)).alias("all"))

    def cam(s: Column) -> g.Camera:
        return g.Camera(*(g.Vec(*(s[f"{a}_{c}"] for c in "xyz")) for a in ("pos", "right", "down", "fwd")))

    def far(a: Column, b: Column) -> Column:
        turned = g.rotation_angle(cam(a), cam(b)) >= min_rotation
        return turned | (g.distance(cam(a).at, cam(b).at) >= min_translation) if min_translation > 0 else turned

    none = F.slice("all", 1, 0)
    chosen = F.aggregate("all", none, lambda acc, x: F.when((F.size(acc) < n) & F.forall(acc, lambda y: far(y, x)), F.concat(acc, F.array(x))).otherwise(acc))
    out = scenes.select("scene_id", chosen.alias("chosen")).where(F.size("chosen") == n)
    return out.select("scene_id", F.posexplode(F.transform("chosen", lambda s: s["view_idx"])).alias("place", "view_idx"))


def chains(seen: DataFrame, length: int, seed: int = 0, views: DataFrame | None = None, min_rotation: float = 15.0, min_translation: float = 0.0) -> DataFrame:
    """Walks node, view, node, view, ... without reuse, one for each scene that has one. Columns
    scene_id, node_0, view_0, ..., view_{length-1}.

    Given views, the pose of each view differs from all earlier ones as in diverse_views; views without
    a pose pass. A search in hash order that turns back at dead ends, over one scene at a time.
    """
    rows = seen.select("scene_id", "view_idx", "node_id").dropna().withColumn("k", key(seed, "scene_id", "view_idx", "node_id"))
    names = [f"{a}_{c}" for a in ("pos", "right", "down", "fwd") for c in "xyz"]
    gated = views is not None and (min_rotation > 0 or min_translation > 0)
    if gated:
        rows = rows.join(views.select("scene_id", "view_idx", *names), ["scene_id", "view_idx"], "left")
    kind = {f.name: f.dataType.simpleString() for f in seen.schema}
    schema = ", ".join([f"scene_id {kind['scene_id']}", *[f"node_{i} {kind['node_id']}, view_{i} {kind['view_idx']}" for i in range(length)]])

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["k", "view_idx", "node_id"])
        views_of, nodes_of, poses, known = {}, {}, {}, {}
        for v, n in zip(pdf["view_idx"], pdf["node_id"]):
            views_of.setdefault(n, []).append(v)
            nodes_of.setdefault(v, []).append(n)
        if gated:
            posed = pdf.dropna(subset=names).drop_duplicates("view_idx")
            poses = dict(zip(posed["view_idx"], posed[names].to_numpy(np.float64)))

        def far(a, b) -> bool:
            if a not in poses or b not in poses:
                return True
            if (a, b) not in known:
                p, q = poses[a], poses[b]
                turned = np.degrees(np.arccos(np.clip((p[3:] @ q[3:] - 1) / 2, -1, 1))) >= min_rotation
                known[a, b] = bool(turned or (min_translation > 0 and np.linalg.norm(p[:3] - q[:3]) >= min_translation))
            return known[a, b]

        def go(nodes: list, used: list) -> list | None:
            for v in views_of[nodes[-1]]:
                if v in used or not all(far(v, u) for u in used):
                    continue
                if len(nodes) == length:
                    return [x for pair in zip(nodes, [*used, v]) for x in pair]
                for n in nodes_of[v]:
                    if n not in nodes and (got := go([*nodes, n], [*used, v])):
                        return got
            return None

        # Nodes that views link to too few others, or by too few views, begin no walk.
        group: dict = {}
        for n in views_of:
            todo, nodes, views = [n] if n not in group else [], set(), set()
            while todo:
                if (x := todo.pop()) not in nodes:
                    nodes.add(x)
                    views.update(views_of[x])
                    todo += [y for v in views_of[x] for y in nodes_of[v] if y not in nodes]
            group |= dict.fromkeys(nodes, len(nodes) >= length and len(views) >= length)
        cols = ["scene_id", *[f"{a}_{i}" for i in range(length) for a in ("node", "view")]]
        found = next((got for n in views_of if group[n] and (got := go([n], []))), None)
        return pd.DataFrame([[pdf["scene_id"].iloc[0], *found]] if found else [], columns=cols)

    return rows.groupBy("scene_id").applyInPandas(walk, schema)
