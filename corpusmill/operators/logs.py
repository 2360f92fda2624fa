"""Training-log analytics with window functions (WIN1-WIN3).

No window is partitioned by run alone: a run may hold a large share of the
log.  Running totals use the distributed per-group prefix of
``ordering.with_group_prefix``; the trailing mean uses blocked windows with
a halo (each block also sees the last ``window - 1`` rows of the one before),
so a window partition holds at most a block and its halo.  ``best_checkpoint`` orders the per-epoch
table (one row per epoch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.ordering import with_group_prefix

BLOCK_ROWS = 4096  # fixed block size of the halo windows (must be >= window)


def trailing_mean(log: DataFrame, every: int = 100, window: int = 100,
                  block: int = BLOCK_ROWS) -> DataFrame:
    """WIN1: at every ``every``-th step of an epoch, the mean of the last
    ``window`` losses of the run (the list spans epochs), rounded to 4.

    ``step`` numbers the run's losses 1, 2, ...; a row belongs to block
    (step-1) // block; the last ``window - 1`` rows of a block are also copied
    into the next one, so the ``window``-row frame of every row lies inside its
    block's partition and a share of window / block of the rows is copied.
    """
    if every < 1 or window < 1:
        raise ValueError("every and window must be >= 1")
    if block < window:
        raise ValueError("block must be >= window")
    copies = with_halo(log, window, block)
    w = Window.partitionBy("run", "block").orderBy("step").rowsBetween(-(window - 1), 0)
    return (copies.withColumn("trailing_loss", F.round(F.avg("loss").over(w), 4))
            .where((F.col("block") == F.col("home")) & (F.col("epoch_step") % every == 0))
            .select("run", "epoch", "epoch_step", "step", "trailing_loss"))


def with_halo(log: DataFrame, window: int, block: int) -> DataFrame:
    """The log with ``home`` (a row's block) and ``block`` (the blocks that see it)."""
    home = F.floor((F.col("step") - 1) / F.lit(block)).cast("long")
    late = F.pmod(F.col("step") - 1, F.lit(block)) > block - window
    rows = log.select("run", "epoch", "epoch_step", "step", "loss", home.alias("home"), late.alias("late"))
    blocks = F.when(F.col("late"), F.array(F.col("home"), F.col("home") + 1)).otherwise(F.array("home"))
    return rows.select("run", "epoch", "epoch_step", "step", "loss", "home", F.explode(blocks).alias("block"))


def best_checkpoint(epochs: DataFrame) -> DataFrame:
    """WIN2: a checkpoint is best when its accuracy beats every earlier one
    (strictly, starting from 0); ties keep the earlier epoch."""
    prior = Window.orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    best_before = F.coalesce(F.max("acc").over(prior), F.lit(0.0))
    return epochs.withColumn("is_best", F.col("acc") > best_before)


def final_best(epochs: DataFrame) -> DataFrame:
    """WIN2 final answer: highest accuracy, earliest epoch on ties (top-1)."""
    return epochs.where(F.col("acc") > 0).orderBy(F.col("acc").desc(), F.col("epoch")).limit(1)


def running_totals(log: DataFrame) -> DataFrame:
    """WIN3: running loss sum and example count, reset every epoch."""
    p = with_group_prefix(log.select("run", "epoch", "step", "loss"), ["run", "epoch"], ["step"],
                          "loss", "examples", "running")
    return p.select("run", "epoch", "step", F.round("running", 6).alias("running_loss"), "examples")
