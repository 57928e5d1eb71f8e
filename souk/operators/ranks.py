"""Global ranking without a single-partition window.

``Window.orderBy(...)`` with no partition key moves every row into one task.
Here the rows are range-partitioned on the sort key (Spark samples the
boundaries, so a hot key value is spread by the tie-break columns), sorted
inside each partition, and numbered with ``monotonically_increasing_id``,
whose upper bits are the partition index and lower 33 bits the position in
the partition.  The numbered rows are checkpointed to the shared checkpoint
folder, so the sampled boundaries are fixed once.  Per-partition counts (at
most #partitions rows per ranking) give each partition's offset; a
broadcast join of that small table adds the offset back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.session import reliable_checkpoint, shuffle_partitions

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def _numbered(df: DataFrame, sort_cols: list[str | Column], num_partitions: int) -> DataFrame:
    """Range partition, sort within partitions, attach (_pid, _pos); materialised once."""
    ranged = (
        df.repartitionByRange(num_partitions, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ranged = reliable_checkpoint(ranged)
    return ranged.withColumn("_pid", F.shiftright("_mid", _POS_BITS)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit(_POS_MASK))
    ).drop("_mid")


def ntile_many(
    df: DataFrame,
    id_col: str,
    specs: dict[str, tuple[str | Column, bool]],
    k: int = 5,
    num_partitions: int | None = None,
    maxima: dict[str, str] | None = None,
) -> DataFrame:
    """NTILE(k) of several numeric orderings in one distributed pass.

    ``specs`` maps an output name to (numeric key, ascending).  Ties are
    broken by ``id_col`` ascending, which must be unique.  NULL keys sort
    first for ascending and last for descending orderings (Spark/SQL
    defaults).  Returns the rows of ``df`` (other columns must be numeric,
    they are carried through a hash aggregate) with one bigint column per
    spec.  ``maxima`` (output name -> column) adds the largest value of a column
    over all rows, taken from the per-partition counts that the ranking needs
    anyway.

    Each input row is expanded into one row per ordering (``explode``), so
    the input is read once; the other columns ride along on the first
    ordering's row and are gathered back by the final group-by on the id.
    """
    spark = df.sparkSession
    num_partitions = num_partitions or shuffle_partitions(spark)
    names, maxima = list(specs), maxima or {}
    payload = [c for c in df.columns if c != id_col]
    entries = []
    for i, name in enumerate(names):
        key, asc = specs[name]
        key = (F.col(key) if isinstance(key, str) else key).cast("double")
        entries.append(
            F.struct(
                F.lit(i).alias("_which"),
                # NULLs first when ascending, last when descending
                F.when(key.isNull(), F.lit(0 if asc else 1)).otherwise(F.lit(1 if asc else 0)).alias("_nulls"),
                (key if asc else -key).alias("_key"),
            )
        )
    stacked = df.select(
        F.col(id_col).alias("_id"), *[F.col(c) for c in payload], F.explode(F.array(*entries)).alias("_s")
    ).select(
        "_id",
        *[F.when(F.col("_s._which") == 0, F.col(c)).alias(c) for c in payload],
        "_s._which",
        "_s._nulls",
        "_s._key",
    )

    pos = _numbered(stacked, ["_which", "_nulls", "_key", "_id"], num_partitions)
    stats = pos.groupBy("_which", "_pid").agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_pos").alias("_first"), *[F.max(c).alias(name) for name, c in maxima.items()]
    )
    before = Window.partitionBy("_which").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0))).withColumn(
        "_n", F.sum("_cnt").over(Window.partitionBy("_which"))
    )
    stats = stats.withColumns({name: F.max(name).over(Window.partitionBy()) for name in maxima})
    # stats has at most len(specs) * num_partitions rows: safe to broadcast.
    ranked = pos.join(F.broadcast(stats), ["_which", "_pid"]).withColumn(
        "_bucket", ntile_bucket(F.col("_off") + F.col("_pos") - F.col("_first") + 1, F.col("_n"), k)
    )
    return ranked.groupBy(F.col("_id").alias(id_col)).agg(
        *[F.max(c).alias(c) for c in payload],
        *[F.max(name).alias(name) for name in maxima],
        *[F.max(F.when(F.col("_which") == i, F.col("_bucket"))).alias(name) for i, name in enumerate(names)],
    )


def ntile_bucket(rn: Column, n: Column, k: int) -> Column:
    """Bucket 1..k of the rn-th of n rows, SQL NTILE rules: the first n mod k
    buckets hold one row more than the others."""
    q = F.floor(n / F.lit(k)).cast("long")
    m = (n - q * F.lit(k)).cast("long")
    big = m * (q + 1)
    first = F.floor((rn - 1) / (q + 1)) + 1
    rest = F.floor((rn - 1 - m) / F.when(q == 0, F.lit(1)).otherwise(q)) + 1
    return F.when(rn <= big, first).otherwise(rest).cast("long")


def average_ranks(df: DataFrame, value_col: str, closed: bool = False, num_partitions: int | None = None) -> DataFrame:
    """Average rank (1-based, ties get the mean of their ranks) per distinct value.

    Returns (value_col, n, rank_before, avg_rank) where rank_before is the
    number of rows with a smaller value.  Works on the value histogram: one
    aggregation of the rows, then prefix sums (``histogram_ranks``).
    """
    hist = df.where(F.col(value_col).isNotNull()).groupBy(value_col).agg(F.count(F.lit(1)).alias("n"))
    return histogram_ranks(hist, value_col, closed, num_partitions)


def histogram_ranks(hist: DataFrame, value_col: str, closed: bool = False, num_partitions: int | None = None) -> DataFrame:
    """average_ranks from (value_col, n, ...): adds rank_before and avg_rank.

    The histogram of a wide column (any number of distinct values) is
    range-partitioned by value; every range sums up its own rows, and the sums
    of the ranges before it (one row per range) are added.  For a column whose
    values are a closed domain (``closed``: review scores, instalment counts) a
    single window over the few dozen values does without the materialisation.
    """
    before = Window.orderBy(value_col).rowsBetween(Window.unboundedPreceding, -1)
    if closed:
        ranked = hist.withColumn("rank_before", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long"))
    else:
        num_partitions = num_partitions or shuffle_partitions(hist.sparkSession)
        pos = _numbered(hist, [value_col], num_partitions)
        ranges = pos.groupBy("_pid").agg(F.sum("n").alias("_in"))  # at most num_partitions rows
        earlier = F.sum("_in").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
        ranges = ranges.select("_pid", F.coalesce(earlier, F.lit(0)).alias("_off"))
        inside = F.sum("n").over(Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1))
        ranked = pos.withColumn("_run", F.coalesce(inside, F.lit(0))).join(F.broadcast(ranges), "_pid")
        ranked = ranked.withColumn("rank_before", (F.col("_off") + F.col("_run")).cast("long")).drop("_pid", "_pos", "_run", "_off")
    return ranked.withColumn("avg_rank", F.col("rank_before") + (F.col("n") + 1) / F.lit(2.0))
