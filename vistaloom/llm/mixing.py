"""Mixing sources to target weights, in DataFrame operations only.

Each document gets the MD5 of its id as a hash-random key. Within a source documents are ordered
by that key; prefix sums of their sizes come in two steps (totals of key ranges, then rows within
a range), so no window holds a whole source. Every source is cut at its exact budget; a budget
above the source's size repeats whole epochs first.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD

GAP = SPACE[:-1] + "*"

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
#: Hex digits of the key that name a range: 16**3 ranges a source.
DIGITS = 3


def size_of(text: Column) -> Column:
    """Number of words; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Sorts by code point, null last, and is never null."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("t"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, white space as it was."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"{GAP}{WORD}"), F.lit(0)), 1, n), "")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source_key, source_size, target, budget) from (source_key, source_size): a row a source.

    The k-th source by code point weighs weights[k mod len]. Targets share the sum of all sizes by
    weight; none passes `most` times its source's size, and the excess goes to the others by weight.
    That is one water level: with sources by rising most*size/weight, those before the first whose
    cap lies above the level are full. budget is the target in whole words. The windows here see
    a row a source, and no documents.
    """
    w = F.element_at(F.lit(list(weights)), ((F.row_number().over(Window.orderBy("source_key")) - 1) % len(weights) + 1).cast("int"))
    one = sizes.withColumn("weight", w).withColumn("cap", (most * F.col("source_size")).cast("double"))
    by = Window.orderBy(F.col("cap") / F.col("weight"), "source_key")
    before, after, all_ = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy(F.lit(1))
    one = one.withColumn("level", (F.sum("source_size").over(all_).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    # Full sources come first; the level at the first that is not full holds for all the rest.
    open_ = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("source_key"), F.col("level")))).over(all_)
    one = one.withColumn("target", F.least(F.col("cap"), F.coalesce(open_["level"], F.lit(float("inf"))) * F.col("weight")))
    return one.select("source_key", "source_size", "target", F.least(F.round("target").cast("long"), most * F.col("source_size")).alias("budget"))


def _planned(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str, kept: Column) -> DataFrame:
    """(__kept, size, source_size, target, taken): `kept` is any column of docs that goes along."""
    # Rows without an id are told apart by their texts.
    own = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))))
    key = F.md5(F.concat(F.lit(f"{seed}:"), own).cast("binary"))
    rows = docs.select(kept.alias("__kept"), source_key(F.col(source_col)).alias("source_key"), size_of(F.col(text_col)).alias("size"), key.alias("key"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("text_hash"))
    rows = rows.withColumn("range", F.substring("key", 1, DIGITS))
    totals = rows.groupBy("source_key", "range").agg(F.sum("size").alias("range_size"))
    plan = targets(totals.groupBy("source_key").agg(F.sum("range_size").alias("source_size")))
    up_to = Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("source_key", "range", F.coalesce(F.sum("range_size").over(up_to), F.lit(0)).alias("base"))
    base = base.join(plan, "source_key")
    within = Window.partitionBy("source_key", "range").orderBy("key", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0))).join(base, ["source_key", "range"])
    some = F.greatest(F.col("source_size"), F.lit(1))
    epochs = F.floor(F.col("budget") / some)
    rest = F.col("budget") - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("base") - F.col("inside")))
    return rows.select("__kept", "size", "source_size", "target", (epochs * F.col("size") + part).cast("long").alias("taken"))


def planned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix") -> DataFrame:
    """docs' (id_col, size, source_size, target, taken), one row per input row.

    taken is the number of words that the mix takes, repeats counted: budget // source_size whole
    epochs, then the words before the cut in key order; so the words taken of a source add up to
    its budget exactly. Null text has size 0, long texts are counted whole, a null source is a source of
    its own (last), and in place of a null id stands the MD5 of the text. Equal ids are ordered by their
    text's hash; wholly equal rows are interchangeable. An empty table gives an empty result; other
    columns are not read.
    """
    return _planned(docs, id_col, text_col, source_col, seed, F.col(id_col)).withColumnRenamed("__kept", id_col)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", chars_col: str | None = "n_chars", seed: str = "mix") -> DataFrame:
    """The mix itself, with the columns of docs: every document as often as the mix takes it.

    A document at a cut ends after the last word taken there (chars_col then counts what is left);
    one of which nothing is taken goes, unless it has no words: wordless documents (null, empty) cost
    nothing and stay once. Repeated rows and null ids count as in planned(); an empty table stays
    empty; extra columns go along, whatever their names.
    """
    plan = _planned(docs, id_col, text_col, source_col, seed, F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    some = F.greatest(F.col("size"), F.lit(1))
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / some)).otherwise(1).cast("int")
    part = F.when(F.col("size") > 0, F.col("taken") % some).otherwise(0)
    copies = F.concat(F.array_repeat(F.lit(-1).cast("long"), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))
    out = plan.select("__kept", F.explode(copies).alias("__words"))
    text = F.col("__kept")[text_col]
    text = F.when(F.col("__words") >= 0, first_words(text, F.col("__words").cast("int"))).otherwise(text)
    chars = lambda c: F.when(F.col("__words") >= 0, F.char_length(text).cast(docs.schema[c].dataType)).otherwise(F.col("__kept")[c])
    return out.select(*[(text if c == text_col else chars(c) if c == chars_col else F.col("__kept")[c]).alias(c) for c in docs.columns])
