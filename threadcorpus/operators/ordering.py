"""Ordering inside groups that may be very large (hot threads, hot communities)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadcorpus.operators import joins
from threadcorpus.operators.bloom import key_filter
from threadcorpus.operators.joins import broadcast_rows, checked_join
from threadcorpus.session import materialize

# Rows of a group that are ranked by one task; a larger group is cut into buckets.
BUCKET_ROWS = 1_000_000


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def rank_in_group(df: DataFrame, keys: Sequence[str], order: Sequence, out: str = "pos",
                  partitions: int | None = None, weight: str | None = None) -> DataFrame:
    """Exact 1-based position of every row inside its ``keys`` group by ``order``.

    With ``weight`` also ``<out>_before``, the sum of that column over the rows before.

    A window partitioned by the group key alone would put a whole group into
    one task. Instead rows are range-partitioned on ``keys + order`` (a hot
    group spans many partitions) and materialized, numbered inside each
    (partition, group) piece, and shifted by the sizes of the group's pieces in
    earlier partitions. ``order`` must be a total order inside a group.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key_cols, order_cols = _cols(keys), _cols(order)
    ranged = materialize(df.repartitionByRange(n, *key_cols, *order_cols)
                         .withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part", *keys).orderBy(*order_cols)
    local = ranged.withColumn("_local", F.row_number().over(inside))
    sums = [F.count("*").alias("_n")]
    if weight:
        earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
        local = local.withColumn("_heavy", F.coalesce(F.sum(weight).over(earlier), F.lit(0)))
        sums.append(F.sum(weight).alias("_w"))
    pieces = ranged.groupBy("_part", *keys).agg(*sums)
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = [F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")]
    if weight:
        shifts.append(F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_woff"))
    offsets = materialize(pieces.select("_part", *keys, *shifts))
    name = _name(keys)
    ranked = checked_join(local.withColumn("_key", name), offsets.withColumn("_key", name).drop(*keys),
                          ["_part", "_key"], "inner")
    if weight:
        ranked = ranked.withColumn(f"{out}_before", (F.col("_heavy") + F.col("_woff")).cast("bigint")).drop("_heavy", "_woff")
    return ranked.withColumn(out, (F.col("_local") + F.col("_off")).cast("bigint")) \
        .drop("_part", "_key", "_local", "_off")


def _name(keys: Sequence[str]) -> Column:
    """One value for several keys; a null key is a group like any other, so it is part of the value."""
    return F.to_json(F.struct(*[F.col(k) for k in keys]), {"ignoreNullFields": "false"})


def _bounds(times: DataFrame, keys: Sequence[str], bucket_rows: int) -> DataFrame | None:
    """``_name, _bucket, _start, _before, _hot`` of every first order value of the groups above ``bucket_rows``.

    A value's bucket follows from the number of rows before it, so a bucket
    has at most ``bucket_rows`` rows and those of one more value; a value of
    more rows than that is hot. None if no group is that large.
    """
    large = materialize(times.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > bucket_rows)
                        .select(_name(keys).alias("_group")))
    if large.isEmpty():
        return None
    inside = checked_join(times.withColumn("_group", _name(keys)), large, "_group", "left_semi").drop("_group")
    counted = inside.groupBy(*keys, "_at").agg(F.count("*").alias("_n"))
    placed = rank_in_group(counted, keys, ["_at"], "_i", weight="_n") \
        .withColumn("_bucket", F.floor(F.col("_i_before") / F.lit(bucket_rows)))
    start = F.min("_i_before").over(Window.partitionBy(*keys, "_bucket"))
    return materialize(placed.select(_name([*keys, "_at"]).alias("_name"), "_bucket", start.alias("_start"),
                                     F.col("_i_before").alias("_before"), (F.col("_n") > bucket_rows).alias("_hot")))


def rank_by_histogram(df: DataFrame, keys: Sequence[str], order: Sequence, out: str = "pos",
                      narrow: DataFrame | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Exact 1-based position of every row inside its ``keys`` group by ``order``, in one shuffle of the rows.

    Groups above ``bucket_rows`` are counted by the values of the first order
    column (ascending, nulls first). The sums of these counts cut a group into
    buckets of consecutive values and tell how many rows stand before each, so
    rows are dealt by (group, bucket) and numbered inside. Only rows of a
    single value that fills more than a bucket are ranked among themselves by
    :func:`rank_in_group` over the other order columns. Nothing is sampled.

    Counting reads the keys and the first order column of ``df``, or of
    ``narrow`` where that has the same rows in these columns at less cost.
    ``order`` must be a total order inside a group.
    """
    order_cols = _cols(order)
    rows = df.withColumn("_at", order_cols[0])
    times = rows if narrow is None else narrow.withColumn("_at", order_cols[0])
    bounds = _bounds(times.select(*keys, "_at"), keys, bucket_rows)

    def numbered(group: Sequence[str]) -> Column:
        return F.row_number().over(Window.partitionBy(*group).orderBy(*order_cols)).cast("bigint")

    if bounds is None:
        return rows.withColumn(out, numbered(keys)).drop("_at")
    named = rows.withColumn("_name", _name([*keys, "_at"]))
    n = broadcast_rows(bounds)
    if n <= joins.BROADCAST_MAX_ROWS:
        marked = checked_join(named, bounds, "_name", "left", small_rows=n)
    else:
        # Rows of small groups stay in place; a few of them may pass the filter, the join keeps them too.
        large = key_filter(bounds, "_name", n_keys=n)
        marked = checked_join(named.where(large), bounds, "_name", "left", max_rows=joins.BROADCAST_MAX_ROWS, small_rows=n) \
            .unionByName(named.where(~large), allowMissingColumns=True)
    hot = F.coalesce("_hot", F.lit(False))
    dealt = marked.where(~hot)
    ranked = dealt.withColumn(out, F.coalesce("_start", F.lit(0)) + numbered([*keys, "_bucket"]))
    if not bounds.where("_hot").isEmpty():
        ties = order_cols[1:] or ["_at"]
        among = rank_in_group(marked.where(hot), [*keys, "_at"], ties, out)
        ranked = ranked.unionByName(among.withColumn(out, F.col("_before") + F.col(out)))
    return ranked.drop("_at", "_name", "_bucket", "_start", "_before", "_hot")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per ``keys``: the row smallest by ``order``, then by its other columns.

    The least row is a partial aggregate, so copies are collapsed map-side before
    the shuffle; a key repeated a million times sends one row per map task, and
    each column of a row travels once.
    """
    rest = [c for c in df.columns if c not in keys]
    order_cols = [c.alias(f"_order{i}") for i, c in enumerate(_cols(order))]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order_cols, *[F.col(c).alias(f"_{i}") for i, c in enumerate(rest)])).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row._{i}").alias(c) for i, c in enumerate(rest)])


def sorted_for_output(df: DataFrame, keys: Sequence[str], order: Sequence,
                      partitions: int | None = None) -> DataFrame:
    """Range-partition and sort so written files hold groups whole-in-order (K9, K5).

    A group larger than a partition continues in the next file, still in order.
    """
    key_cols, order_cols = _cols(keys), _cols(order)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *key_cols, *order_cols).sortWithinPartitions(*key_cols, *order_cols)
