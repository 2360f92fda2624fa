"""Ordering, numbering, top-k and batching (SRT1-SRT6, SMP6, JN10).

``with_row_index`` gives a dense 0-based index in a global order without a
single-partition window: a range-partitioned sort, per-partition counts (one
row per partition) and an offset join.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.session import adaptive_caching, reliable_checkpoint


def with_row_index(df: DataFrame, order: list[Column], name: str = "row_index") -> DataFrame:
    """Dense 0-based index following ``order`` (ties broken arbitrarily).

    The sorted frame is checkpointed so the numbering is stable across
    re-evaluation and survives executor loss.  Only one row per partition
    reaches the offset table, so its size is bounded by the partition count.
    """
    # the range partitioner samples its input in a separate job: persist so
    # the upstream plan runs once
    adaptive_caching(df.sparkSession)
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    sorted_df = (src.orderBy(*order)
                 .withColumn("_pid", F.spark_partition_id())
                 .withColumn("_mid", F.monotonically_increasing_id()))
    sorted_df = reliable_checkpoint(sorted_df)
    src.unpersist()
    counts = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: bounded by the partition count
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    out = sorted_df.join(F.broadcast(offsets), "_pid")
    idx = (F.coalesce(F.col("_off"), F.lit(0))
           + (F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)))
    return out.withColumn(name, idx.cast("long")).drop("_pid", "_mid", "_off")


def number_rows(df: DataFrame, order: list[Column], name: str = "row_index") -> DataFrame:
    """SRT4: running 0-based index."""
    return with_row_index(df, order, name)


def row_range(spark, start: int, end: int) -> DataFrame:
    """SRT4: integer range [start, end)."""
    return spark.range(start, end).withColumnRenamed("id", "value")


def drop_rows(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """SRT3: skip the first n rows of an explicit order."""
    if n < 0:
        raise ValueError("n must be >= 0")
    index = "__dropped_index"
    return with_row_index(df, order, index).where(F.col(index) >= n).drop(index)


def top_n(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """SRT1/SRT5: top-N by an order (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def top_repositories(repos: DataFrame, n: int = 1000, lang: str | None = None,
                     repo_col: str = "repo", lang_col: str = "lang",
                     stars_col: str = "stars") -> DataFrame:
    """SRT1: top-N repositories by stars in a language."""
    r = repos if lang is None else repos.where(F.col(lang_col) == F.lit(lang))
    return top_n(r, n, [F.col(stars_col).desc(), F.col(repo_col)])


def seeded_rank(key: Column, seed: int | str) -> Column:
    """md5 rank key of ``seed:key``: a partition-independent random order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def seeded_shuffle(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """SMP6: a seeded random order (training); the rank column is kept."""
    return df.withColumn("shuffle_key", seeded_rank(F.col(id_col), seed)).orderBy("shuffle_key", id_col)


def fixed_batches(df: DataFrame, size: int, order: list[Column],
                  index_col: str = "row_index") -> DataFrame:
    """SRT6: consecutive fixed-size batches; the last one may be short."""
    if size < 1:
        raise ValueError("batch size must be >= 1")
    indexed = df if index_col in df.columns else with_row_index(df, order, index_col)
    return indexed.withColumn("batch", F.floor(F.col(index_col) / F.lit(size)).cast("long"))


def zip_rows(a: DataFrame, b: DataFrame, order_a: list[Column], order_b: list[Column],
             index_col: str = "row_index") -> DataFrame:
    """JN10: positional pairing of two frames; ends at the shorter one."""
    ia = with_row_index(a, order_a, index_col)
    ib = with_row_index(b, order_b, index_col)
    return ia.join(ib, index_col, "inner")


def batch_count(n_rows: Column, batch_size: int, accumulation_steps: int = 1) -> Column:
    """AGG15: loader batches after dividing the batch size by accumulation."""
    per_step = batch_size // accumulation_steps
    if per_step < 1:
        raise ValueError("batch_size // accumulation_steps must be >= 1")
    return F.ceil(n_rows / F.lit(per_step)).cast("long")


def with_group_prefix(df: DataFrame, group_cols: list[str], order_cols: list[str],
                      value_col: str | None = None, index_name: str = "row_number",
                      sum_name: str = "prefix_sum",
                      sub_groups: dict[str, list[str]] | None = None) -> DataFrame:
    """Per-group 1-based row number (and running sum of ``value_col``) in
    ``order_cols`` order, without putting a group into one task.

    Rows are range-partitioned on (group, order), so a hot group spans many
    partitions.  Each partition numbers its rows locally (a window over
    (partition, group) is bounded by the partition), and one total per
    (partition, group) gives the offsets of the earlier partitions (a group
    spans at most all partitions, so that window is bounded too).  The
    sorted frame is checkpointed so the numbering is stable.

    ``sub_groups`` maps extra index names to finer groupings (each containing
    ``group_cols``); they are numbered in the same pass, which is exact
    because earlier partitions hold only earlier rows of every group.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    adaptive_caching(spark)
    levels = {index_name: list(group_cols)}
    for name, cols in (sub_groups or {}).items():
        if not set(group_cols) <= set(cols):
            raise ValueError("a sub-group must contain the outer group columns")
        levels[name] = list(cols)
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    keys = [F.col(c) for c in group_cols + order_cols]
    local = (src.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
             .withColumn("_pid", F.spark_partition_id()))
    for i, (name, cols) in enumerate(levels.items()):
        w = (Window.partitionBy("_pid", *cols).orderBy(*order_cols)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        local = local.withColumn(f"_ln{i}", F.count(F.lit(1)).over(w))
        if i == 0 and value_col is not None:
            local = local.withColumn("_ls", F.sum(value_col).over(w))
    local = reliable_checkpoint(local)
    src.unpersist()
    out = local
    for i, (name, cols) in enumerate(levels.items()):
        aggs = [F.count(F.lit(1)).alias("_cn")]
        if i == 0 and value_col is not None:
            aggs.append(F.sum(value_col).alias("_cs"))
        totals = local.groupBy("_pid", *cols).agg(*aggs)
        before = Window.partitionBy(*cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
        offs = totals.select("_pid", *cols,
                             F.coalesce(F.sum("_cn").over(before), F.lit(0)).alias(f"_on{i}"),
                             *([F.coalesce(F.sum("_cs").over(before), F.lit(0.0)).alias("_os")]
                               if i == 0 and value_col is not None else []))
        out = out.join(offs, ["_pid", *cols])
        out = out.withColumn(name, (F.col(f"_on{i}") + F.col(f"_ln{i}")).cast("long"))
        out = out.drop(f"_on{i}", f"_ln{i}")
    if value_col is not None:
        out = out.withColumn(sum_name, F.col("_os") + F.col("_ls")).drop("_os", "_ls")
    return out.drop("_pid")
