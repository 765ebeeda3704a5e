"""Exact work on groups too large for one task.

Joins followed by an aggregate need nothing here: adaptive execution splits their hot partitions,
and aggregates combine before the shuffle. Windows are different, since a window keeps each group in
one task, so the few groups above ``hot_rows`` take another route with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.session import staged

HOT_ROWS = 5_000_000
SAMPLE = 0.01


def heavy_keys(
    df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, fraction: float = SAMPLE
) -> DataFrame:
    """Keys that hold about ``hot_rows`` rows or more, as a written table.

    The keys are looked for in a sample of the key columns. The sample only picks a route, and both
    routes are exact, so a key missed or added near the limit does not change any result. There are
    at most 2 * rows / hot_rows such keys. They are not collected: Spark knows the size of what is
    written when it plans the joins with it.
    """
    seen = df.select(*keys).na.drop()
    if fraction < 1:
        seen = seen.sample(fraction, seed=7)
    heavy = seen.groupBy(*keys).count().filter(F.col("count") >= hot_rows * fraction / 2).drop("count")
    return staged(heavy, "heavy")


def split_heavy(
    df: DataFrame,
    keys: list[str],
    hot_rows: int = HOT_ROWS,
    fraction: float = SAMPLE,
    seen_in: DataFrame | None = None,
    heavy: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ordinary groups, and those of heavy groups if any.

    ``seen_in`` is where to look for heavy keys if that is cheaper than ``df``: a frame with at
    least the rows of ``df``, before a costly filter or join. ``heavy`` are keys already found.
    """
    if heavy is None:
        heavy = heavy_keys(df if seen_in is None else seen_in, keys, hot_rows, fraction)
    if heavy.isEmpty():
        return df, None
    return df.join(heavy, keys, "left_anti"), df.join(heavy, keys, "left_semi")


def _number_heavy(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """Number each group from 0 by sorting the rows over all partitions and adding offsets.

    The sorted rows are written once, so the partition numbers the offsets rely on cannot change.
    The added row id lets the sort split rows that agree in everything.
    """
    ranked = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys, *order, "_tie")
        .sortWithinPartitions(*keys, *order, "_tie")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id())
        .drop("_tie")
    )
    ranked = staged(ranked, "numbered")
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranked.groupBy(*keys, "_part")
        .agg(F.min("_seq").alias("_first"), F.count("*").alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first"))
        .drop("_first", "_rows")
    )
    # one row per partition and per heavy key, at most
    starts = staged(starts, "starts")
    return (
        ranked.join(starts, [*keys, "_part"])
        .withColumn(out, (F.col("_seq") + F.col("_offset")).cast("int"))
        .drop("_part", "_seq", "_offset")
    )


def number_rows(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    out: str,
    hot_rows: int = HOT_ROWS,
    fraction: float = SAMPLE,
    seen_in: DataFrame | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Add the row's position within its group, from 0; an existing column ``out`` is replaced."""
    columns = [c for c in df.columns if c != out] + [out]
    cold, hot = split_heavy(df, keys, hot_rows, fraction, seen_in, heavy)
    window = Window.partitionBy(*keys).orderBy(*order)
    numbered = cold.withColumn("_position", F.row_number().over(window) - 1)
    if hot is not None:
        numbered = numbered.unionByName(_number_heavy(hot, keys, order, "_position"))
    return numbered.withColumn(out, F.col("_position")).select(*columns)


def largest_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of every group.

    Spark keeps at most ``n`` rows per group and task before the shuffle, so hot groups stay small.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
