"""Per-key running sums that stay balanced when one key holds a large share of all rows.

Two plans: fixed-width order blocks when the order is one integral column
(``blocked_running_sum``), else range partitioning (``ranged_running_sum``, below).

``Window.partitionBy(key).orderBy(...)`` puts every row of a key into one task, so a single
hot key (one conversation with a third of all rows) would serialise the whole job. The blocked
scan below splits the work:

1. range-partition the (narrow) rows by ``(key, order...)`` -- a hot key's rows are cut into
   many consecutive ranges, each one task;
2. inside each range, a window partitioned by ``(range, key)`` gives the local running sum;
3. the per-(range, key) totals (one row per key per range, so at most ``ranges`` rows for the
   hottest key) get an exclusive running sum over the ranges of the same key -- the offset;
4. offset + local sum is the global running sum.

Only narrow columns travel through these steps; callers join the result back to wide rows
on a key that includes the order columns, which spreads a hot key over many tasks too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from castwright.session import materialize

INTEGRAL = ("tinyint", "smallint", "int", "bigint")
DEFAULT_BLOCK_ROWS = 4096


def running_sum(df: DataFrame, key: str, order: list[str] | tuple[str, ...], value: str, out: str,
                ranges: int | None = None, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Inclusive running sum of ``value`` per ``key`` in ``order`` (skew-safe).

    A single integral order column (a turn or position number) uses fixed-width order blocks
    (``blocked_running_sum``): no sampling pass and no broadcast. Any other order uses range
    partitioning (``ranged_running_sum``). Blocks assume positions (dense integers); for a
    sparse integral order pass ``block_rows=0`` to force the range plan."""
    if block_rows <= 0:
        return ranged_running_sum(df, key, list(order), value, out, ranges)
    order = list(order)
    if len(order) == 1 and df.schema[order[0]].dataType.simpleString() in INTEGRAL:
        return blocked_running_sum(df, key, order[0], value, out, block_rows)
    return ranged_running_sum(df, key, order, value, out, ranges)


def blocked_running_sum(df: DataFrame, key: str, order: str, value: str, out: str,
                        block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Running sum for an integral order column, with the order cut into blocks of
    ``block_rows`` consecutive values.

    Rows are hash-partitioned by (key, block), so a hot key is spread over many tasks and
    each (key, block) group holds at most ``block_rows`` rows (order values are unique per
    key). The block totals come from the same partitioning (map-side aggregate), their
    exclusive running sum per key is computed on the small totals table (one row per block),
    and joined back on (key, block): only the totals move in that join."""
    blocked = df.withColumn("_block", F.floor(F.col(order) / F.lit(block_rows)).cast("bigint"))
    local_w = Window.partitionBy(key, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = blocked.withColumn("_local", F.sum(value).over(local_w))
    totals = local.groupBy(key, "_block").agg(F.sum(value).alias("_total"))
    prev_w = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(key, "_block", F.coalesce(F.sum("_total").over(prev_w), F.lit(0)).alias("_offset"))
    return local.join(offsets, [key, "_block"]).select(
        *df.columns, (F.col("_local") + F.col("_offset")).alias(out))


def ranged_running_sum(df: DataFrame, key: str, order: list[str] | tuple[str, ...], value: str, out: str,
                       ranges: int | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` per ``key`` in ``order``; returns ``df``'s columns plus
    ``out``. ``order`` must make rows unique within a key.

    Offsets are only needed for keys that cross a range boundary, and such a key is the first
    or last key of every range it touches. So the offset table has at most two rows per range
    (a bound fixed by ``ranges``, not by the data) and is broadcast back; every other key's
    offset is 0.
    """
    spark = df.sparkSession
    n = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    order = list(order)
    # The ranges are fixed by writing them: a plan that reads the exchange again (columns pruned
    # differently) would sample other bounds.
    ranged = materialize(df.repartitionByRange(n, F.col(key), *[F.col(c) for c in order]).withColumn(
        "_range", F.spark_partition_id()), "ranges")
    local_w = Window.partitionBy("_range", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("_local", F.sum(value).over(local_w))
    # first and last key of each range: <= 2 * ranges rows
    edges = local.groupBy("_range").agg(F.min(key).alias("_lo"), F.max(key).alias("_hi")).select(
        "_range", F.explode(F.array("_lo", "_hi")).alias(key)).distinct()
    totals = local.join(F.broadcast(edges), ["_range", key]).groupBy("_range", key).agg(
        F.sum(value).alias("_total"))
    prev_w = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", key, F.coalesce(F.sum("_total").over(prev_w), F.lit(0)).alias("_offset"))
    return local.join(F.broadcast(offsets), ["_range", key], "left").select(
        *df.columns, (F.col("_local") + F.coalesce(F.col("_offset"), F.lit(0))).alias(out))


E_NO_POSITION = "piece has no position"
E_REPEATED_POSITION = "position is repeated"


def one_per_position(rows: DataFrame, key: str, order: tuple[str, ...], text: str) -> DataFrame:
    """(key, *order, text): one piece for each position, the smallest text where a position is
    repeated; pieces without a position have no place (``position_rejects`` reports both).

    Whether any position is repeated is found over keys and positions alone; only then are the texts
    compared (a minimum of texts sorts them). That chooses the plan, not the result."""
    placed = rows.dropna(subset=[*order]).select(key, *order, text)
    most = placed.groupBy(key, *order).count().agg(F.max("count")).first()[0] or 0
    return placed if most <= 1 else placed.groupBy(key, *order).agg(F.min(text).alias(text))


def position_rejects(rows: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """(key, *order, n_rejected, error): how many pieces of a job were left out at a position, and why."""
    absent = F.lit(False)
    for c in order:
        absent = absent | F.col(c).isNull()
    counted = rows.groupBy(key, *order).agg(F.count(F.lit(1)).alias("_n")).withColumn("_absent", absent)
    lost = F.when(F.col("_absent"), F.col("_n")).otherwise(F.col("_n") - 1)
    return counted.select(key, *order, lost.alias("n_rejected"),
                          F.when(F.col("_absent"), F.lit(E_NO_POSITION)).otherwise(F.lit(E_REPEATED_POSITION)).alias("error")
                          ).where("n_rejected > 0")
