"""Connected components of a link table, wholly in DataFrame operations."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, shared_dir


#: Links that one task may join in memory (32 bytes a link): beyond it, distributed rounds come first.
FINISH = 200_000


def _finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    up: dict[int, int] = {}

    def find(i: int) -> int:
        while (p := up.setdefault(i, i)) != i:
            up[i] = up[p]
            i = p
        return i

    for pdf in batches:
        for x, y in zip(pdf["a"].tolist(), pdf["b"].tolist()):
            x, y = find(x), find(y)
            up[max(x, y)] = min(x, y)
    yield pd.DataFrame({"node": list(up), "parent": [find(i) for i in list(up)]}, dtype="int64")


def connected_components(links: DataFrame, a: str = "a", b: str = "b", finish: int = FINISH, left_each: list[int] | None = None) -> DataFrame:
    """(node, root) for every node of an undirected link table; root is a node of the component.

    Each round ranks the nodes by a hash of their own and of the round, points every node at its
    least ranked neighbour (or itself) and contracts the links to those parents. A node that ranks
    highest among its neighbours goes in that round, and ranks are drawn anew each time, so the number
    of nodes falls geometrically (in expectation) whatever the labels and the diameter: a path of n
    nodes in any order takes O(log n) rounds. Tables of a round are written to the shared folder;
    nothing but a count reaches the driver (left_each, if given, gets the links of every round).
    Nulls and self-links count for nothing; an empty table gives an empty table.
    """
    spark = links.sparkSession
    made: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        made.append(shared_dir(spark))
        df.write.parquet(made[-1])
        return spark.read.schema(df.schema).parquet(made[-1])

    rest = keep(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b"))
    roots = rest.select(F.col("a").alias("node"), F.col("b").alias("root")).where("false")
    turn = 0
    while n := rest.count():
        if left_each is not None:
            left_each.append(n)
        if n <= finish:
            parent = keep(rest.coalesce(1).mapInPandas(_finish, "node long, parent long"))
        else:
            both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
            ranked = lambda node: F.struct(F.xxhash64(F.lit(turn), F.col(node)), F.col(node).alias("node"))  # noqa: B023, E731
            least = both.groupBy(F.col("a").alias("node")).agg(F.min(ranked("b")).alias("least"))
            parent = keep(least.select("node", F.least(ranked("node"), "least")["node"].alias("parent")))
        if not turn:
            roots = parent.select("node", F.col("parent").alias("root"))
        else:
            up = parent.select(F.col("node").alias("root"), F.col("parent").alias("up"))
            roots = keep(roots.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")))
        if n <= finish:
            break
        turn += 1
        left = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        next_ = rest.join(left, "a").join(right, "b").where("pa <> pb")
        rest = keep(next_.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
        for path in made[:-4]:  # older rounds are no longer read
            remove(spark, path)
        del made[:-4]
    return roots
