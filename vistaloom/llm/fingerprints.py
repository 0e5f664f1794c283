"""Document fingerprints: bottom-k sketches of word-shingle hashes, in DataFrame operations only.

A sketch is the ascending array of the k smallest distinct 64-bit hashes of a text's shingles of
`words` words. Sketches merge by taking the k smallest of their union, so they can be built in
parts; two sketches estimate the resemblance (Jaccard) and containment of their shingle sets, and
one sketch the number of distinct shingles. A sketch of fewer than k hashes holds the whole set,
and estimates between two such are exact.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LEAST, SPACE, bound, bounds, numbers, range_key, range_of

K = 256
WORDS = 5


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    """Bottom-k sketch (array<bigint>) of a whole text, case ignored.

    A text of fewer words than a shingle has one shingle: all its words. Null and wordless texts
    have an empty sketch.
    """
    shingles = lambda each: F.when(F.size(each) > 0, F.transform(F.sequence(F.lit(1), F.greatest(F.size(each) - (words - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(each, i, words))))
    hashed = F.transform(F.filter(F.split(F.lower(text), SPACE), lambda w: w != ""), lambda w: F.xxhash64(w))
    return F.coalesce(F.slice(F.sort_array(F.array_distinct(bound(hashed, shingles))), 1, k), F.array().cast("array<bigint>"))


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two parts."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness of two shingle sets, 0 to 1; of two empty ones 1."""
    full = (F.size(a) >= k) | (F.size(b) >= k)
    union = F.when(full, merge(a, b, k)).otherwise(F.array_union(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(F.size(F.array_intersect(F.array_intersect(a, b), union)) / F.size(union)).cast("double")


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k-1) over the k-th hash's quantile."""
    quantile = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / quantile)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has, 0 to 1; of an empty a 1."""
    union = F.when((F.size(a) >= k) | (F.size(b) >= k), merge(a, b, k)).otherwise(F.array_union(a, b))
    own = F.array_intersect(a, union)
    return F.when(F.size(own) == 0, 1.0).otherwise(F.size(F.array_intersect(own, b)) / F.size(own)).cast("double")


def as_text(a: Column) -> Column:
    """A sketch as text: 16 hex digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def merged_by(sketches: DataFrame, key: str, column: str = "sketch", k: int = K) -> DataFrame:
    """(key, sketch): the sketch of each key's union, merged map-side, over salted parts first.

    No task gathers a key: ranks stop at k within each salt and then within each key. Null and
    empty sketches add nothing; a key with only such has an empty sketch.
    """
    hashes = sketches.select(F.col(key).alias("k"), F.explode_outer(column).alias("h")).distinct()
    salted = Window.partitionBy("k", F.pmod("h", F.lit(64))).orderBy("h")
    some = hashes.where("h is not null").withColumn("n", F.row_number().over(salted)).where(F.col("n") <= k)
    least = some.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("h"))).where(F.col("n") <= k)
    least = least.groupBy("k").agg(F.sort_array(F.collect_list("h")).alias("sketch"))  # k at most
    keys = hashes.select("k").distinct()
    return keys.join(least, keys["k"].eqNullSafe(least["k"]), "left").select(keys["k"].alias(key), F.coalesce("sketch", F.array().cast("array<bigint>")).alias("sketch"))


def with_next(docs: DataFrame, id_col: str, text_col: str, columns: dict[str, Column], rows_each: int = 4000) -> DataFrame:
    """(id, text, next_text, *columns, next_*): every document beside the one of the next higher id.

    Ranges of ids hold about rows_each documents; the first document of a range, which is one that a
    bound names, also goes to the range before, and the first of all behind the last. So one exchange
    of texts does, and no window holds more than a range. Null ids come first, by a hash of their text;
    equal ids by text.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("key", range_key(F.col("id"), F.col("text")))
    cuts = bounds(rows, "key", rows_each)
    if not cuts:
        cuts = [LEAST]
    own = range_of(F.col("key"), cuts)
    first = F.col("key") == F.get(numbers(cuts), own)
    places = F.concat(
        F.array(F.struct(own.alias("range"), F.lit(0).alias("guest"))),
        F.when(first & (own > 0), F.array(F.struct((own - 1).alias("range"), F.lit(1).alias("guest")))).otherwise(F.expr("array()").cast("array<struct<range:int,guest:int>>")),
        F.when(F.col("key") == cuts[0], F.array(F.struct(F.lit(len(cuts) - 1).alias("range"), F.lit(2).alias("guest")))).otherwise(F.expr("array()").cast("array<struct<range:int,guest:int>>")),
    )
    rows = rows.select("*", F.explode(places).alias("at")).select("id", "text", "key", "at.range", "at.guest")
    rows = rows.repartition(F.col("range")).select("*", *[c.alias(n) for n, c in columns.items()])
    order = Window.partitionBy("range").orderBy("guest", "key", "id", "text")
    rows = rows.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in ("text", *columns)])
    return rows.where("guest = 0").drop("key", "range", "guest")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, words: int = WORDS) -> DataFrame:
    """Fingerprints of every document and of an edited text of it.

    The edited text ends with the beginning of the next document, by ascending id, in place of its
    own last floor(n_chars / 4) code points; after the last comes the first. Per input row: id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint (as_text), near_edited and near_next
    (resemblance to the edited text and to the next document), contained (share of its shingles that
    the edited text keeps) and shingles (estimated). Null text counts as empty; long texts are read
    whole. Null ids come first, by a hash of their text, equal ids are ordered by text, repeated rows
    stand side by side; a lone document is its own next, and an empty table stays empty. Other columns
    are not read.
    """
    rows = with_next(docs, id_col, text_col, {"sketch": sketch(F.col("text"), k, words)})
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut)))
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited"), k, words))
    return rows.select(
        F.col("id").alias(id_col),
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        containment(F.col("sketch"), F.col("edited_sketch"), k).alias("contained"),
        distinct_shingles(F.col("sketch"), k).alias("shingles"),
    )
