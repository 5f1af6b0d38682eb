"""Ordered per-group operators that split groups of any size.

A window partitioned by the group, or one ``collect_list`` over it, sorts the
whole group in one task: right for ordinary groups, wrong for one that holds a
third of all rows. Groups are counted first (a partial aggregation). Where none
exceeds ``SPLIT`` rows, one shuffle by group does. Otherwise the rows of the large
groups are dealt to buckets of about ``SPLIT`` rows at cut points that follow the
data: quantiles of a sample of the group's own sort keys. The sample takes the keys
whose hash lies below a share, so samples of parts of the data add up to the
sample of the whole, and a recomputed task takes the same keys.

* :func:`ordered_concat` — ``string_agg(text, sep ORDER BY …)`` per group:
  each (group, bucket) becomes one sorted partial string, the group's partials
  are joined in bucket order. The result itself is one string per group.
* :func:`group_positions` — ``row_number() OVER (PARTITION BY g ORDER BY …)``:
  rows are numbered within (group, bucket); each bucket's offset is the sum of
  the counts before it.

Everything is a built-in expression, and nothing passes through the driver but
whether there is a large group. Cut points steer the work, never the result.

Order keys must form a total order (append a unique key) so that positions
are stable when a task is recomputed after an executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a bucket, about, and sampled keys for each bucket.
SPLIT, SAMPLES = 100_000, 32
#: Buckets of a group at most (a power of two); larger groups have larger buckets.
MOST = 1024


def cut_points(df: DataFrame, group_cols: Sequence[str], key: Column, split: int | None = None, sizes: DataFrame | None = None) -> DataFrame | None:
    """``group_cols + [_cuts]``: ascending cut points of each large group; None if there is none.

    ``sizes``: a frame whose groups are at least as large, where that is cheaper to count.
    """
    split = split or SPLIT
    counted = (df if sizes is None else sizes).groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > split)
    if counted.isEmpty():
        return None
    large = counted.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group_cols)], "_n", F.least(F.lit(MOST), F.ceil(F.col("_n") / split)).cast("int").alias("_buckets"))
    same = reduce(and_, (F.col(f"_k{i}").eqNullSafe(F.col(f"_g{i}")) for i in range(len(group_cols))))
    keyed = df.select(*[F.col(g).alias(f"_k{i}") for i, g in enumerate(group_cols)], key.alias("_key")).join(large, same)
    share = (F.xxhash64("_key") / F.lit(2.0**64) + 0.5) * F.col("_n") < SAMPLES * F.col("_buckets")
    sampled = keyed.where(share).groupBy(*[f"_g{i}" for i in range(len(group_cols))]).agg(F.sort_array(F.collect_list("_key")).alias("_s"), F.max("_buckets").alias("_buckets"))
    at = F.expr("array_distinct(transform(sequence(1, _buckets - 1), i -> element_at(_s, 1 + cast(i * cast(size(_s) as bigint) div _buckets as int))))")
    return sampled.select(*[F.col(f"_g{i}").alias(g) for i, g in enumerate(group_cols)], at.alias("_cuts"))


def with_bucket(df: DataFrame, group_cols: Sequence[str], key: Column, cuts: DataFrame) -> DataFrame:
    """``df`` plus ``_b``: how many cut points of its group a row's key has reached (0 in
    the others), by binary search."""
    names = [F.col(g).alias(f"_g{i}") for i, g in enumerate(group_cols)]
    same = reduce(and_, (F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group_cols)))
    joined = df.withColumn("_key", key).join(cuts.select(*names, "_cuts"), same, "left")
    steps = F.array(*[F.lit(MOST >> k) for k in range(1, MOST.bit_length())])

    def step(at: Column, by: Column) -> Column:
        reached = (at + by <= F.size("_cuts")) & (F.element_at("_cuts", F.least(at + by, F.greatest(F.size("_cuts"), F.lit(1)))) <= F.col("_key"))
        return F.when(reached, at + by).otherwise(at)

    place = F.when(F.size("_cuts") > 0, F.aggregate(steps, F.lit(0), step)).otherwise(0)
    return joined.select(*df.columns, F.coalesce(place, F.lit(0)).alias("_b"))


def _joined_texts(entries: Column, sep: str) -> Column:
    """``collect_list`` of ``struct(k, t)`` → texts in key order joined by
    ``sep``, NULL when there is no text. Native expressions only: the struct
    sort and the field extraction need no lambda."""
    return F.when(F.max(F.col("_e.t").isNotNull()), F.array_join(F.sort_array(entries).getField("t"), sep))


def ordered_concat(df: DataFrame, group_cols: Sequence[str], key: Column, text_col: str, sep: str, out_col: str,
                   split: int | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """Per group, ``text_col`` values joined by ``sep`` in ascending ``key`` order.

    ``key`` is a struct whose ascending order is the wanted order (encode
    descending / NULLS LAST fields inside it); rows with equal keys must
    carry equal texts. Returns ``group_cols + [out_col]``; NULL groups are
    dropped, NULL texts skipped (all-NULL gives NULL). ``split``, ``sizes``: see
    :func:`cut_points`.
    """
    group_cols = list(group_cols)
    clean = df.where(reduce(and_, (F.col(g).isNotNull() for g in group_cols)))
    cuts = cut_points(clean, group_cols, key, split, sizes)
    if cuts is None:
        keyed = clean.select(*group_cols, F.struct(key.alias("k"), F.col(text_col).alias("t")).alias("_e"))
        return keyed.groupBy(*group_cols).agg(_joined_texts(F.collect_list("_e"), sep).alias(out_col))
    keyed = with_bucket(clean, group_cols, key, cuts).select(*group_cols, "_b", F.struct(key.alias("k"), F.col(text_col).alias("t")).alias("_e"))
    parts = keyed.groupBy(*group_cols, "_b").agg(_joined_texts(F.collect_list("_e"), sep).alias("_part"))
    merged = F.array_join(F.sort_array(F.collect_list(F.struct("_b", "_part"))).getField("_part"), sep)
    return parts.groupBy(*group_cols).agg(F.when(F.max(F.col("_part").isNotNull()), merged).alias(out_col))


def group_positions(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column], key: Column, out_col: str = "pos",
                    split: int | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """``df`` plus ``out_col`` = 1-based position of each row within its group.

    Equals ``row_number() OVER (PARTITION BY group_cols ORDER BY order_cols)``;
    NULL group keys are numbered as their own group. ``key`` is a struct whose
    ascending order is that order. The rows are shuffled once; only buckets' counts
    meet per group. ``split``, ``sizes``: see :func:`cut_points`.
    """
    cuts = cut_points(df, group_cols, key, split, sizes)
    if cuts is None:
        place = F.row_number().over(Window.partitionBy(*group_cols).orderBy(*order_cols))
        return df.withColumn(out_col, place.cast("long"))
    # A flag and a stand-in for each group column: keys without NULLs, so that the
    # join below is on the columns that the rows are already dealt by.
    zero = {f.name: f.dataType for f in df.schema.fields}
    stand = [c for i, g in enumerate(group_cols) for c in (F.col(g).isNull().alias(f"_f{i}"), F.coalesce(F.col(g), F.lit("0").try_cast(zero[g])).alias(f"_v{i}"))]
    keys = [c for i in range(len(group_cols)) for c in (f"_f{i}", f"_v{i}")] + ["_b"]
    bucketed = with_bucket(df, group_cols, key, cuts).select("*", *stand)
    counts = bucketed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys[:-1]).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = bucketed.withColumn("_lpos", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols)).cast("long"))
    return local.join(offsets, keys).select(*df.columns, (F.col("_lpos") + F.col("_off")).alias(out_col))
