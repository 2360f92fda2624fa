"""Split files by repository without leakage (PRJ4-PRJ5, SMP1-SMP2, AGG9-AGG10, SET2).

Repositories are drawn by an md5 rank of ``seed:key`` instead of a library
RNG over listing order: the same split on any partitioning.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import repo_key, repo_name
from corpusmill.operators.ordering import seeded_rank, with_row_index

SET_NAMES = ("test", "validation", "train")


def with_repo_columns(files: DataFrame, name_col: str = "filename") -> DataFrame:
    """PRJ4/PRJ5: add repo_key and repo_name."""
    return files.withColumn("repo_key", repo_key(name_col)).withColumn("repo_name", repo_name("repo_key"))


def validate_shares(test: float, train: float, validation: float) -> None:
    """PRJ23: shares within [0, 1] summing to 1 within 1e-5."""
    for v in (test, train, validation):
        if v < 0 or v > 1:
            raise ValueError(f"share out of range: {v}")
    if abs(1 - (test + train + validation)) > 0.00001:
        raise ValueError(f"train + test + validation must be 1, got {test + train + validation}")


def repo_sets(files: DataFrame, test: float, train: float, validation: float,
              seed: int = 42, name_col: str = "filename") -> DataFrame:
    """(repo_key, set): test = floor(test*R), validation = floor(validation*R),
    train = the rest, drawn without replacement by seeded rank."""
    validate_shares(test, train, validation)
    keys = with_repo_columns(files.select(name_col), name_col).select("repo_key").distinct()
    ranked = with_row_index(keys.withColumn("_r", seeded_rank(F.col("repo_key"), seed)),
                            [F.col("_r"), F.col("repo_key")], "rank")
    r = ranked.count()  # reads the checkpointed ranking
    n_test = int(math.floor(test * r))
    n_val = int(math.floor(validation * r))
    s = (F.when(F.col("rank") < n_test, F.lit("test"))
         .when(F.col("rank") < n_test + n_val, F.lit("validation"))
         .otherwise(F.lit("train")))
    return ranked.select("repo_key", s.alias("set"))


def split_by_repo(files: DataFrame, test: float = 0.1, train: float = 0.8,
                  validation: float = 0.1, seed: int = 42, name_col: str = "filename") -> DataFrame:
    """SMP1: (set, repo_name, filename); every file follows its repository.

    The repository table is one row per repository; it is joined by key
    (Spark broadcasts it only when its measured size is under the threshold).
    """
    sets = repo_sets(files, test, train, validation, seed, name_col)
    f = with_repo_columns(files, name_col)
    return f.join(sets, "repo_key").select("set", "repo_name", name_col)


def split_leakage(splits: DataFrame, files: DataFrame, name_col: str = "filename") -> DataFrame:
    """SMP2/SET2: (check, violations) rows; both must be 0.

    repos_in_several_sets: repositories assigned to more than one set;
    unassigned_files: files of the listing that no set contains.
    """
    multi = (splits.groupBy("repo_name").agg(F.countDistinct("set").alias("n_sets"))
             .agg(F.count_if(F.col("n_sets") > 1).alias("violations"))
             .select(F.lit("repos_in_several_sets").alias("check"), "violations"))
    missing = (files.select(name_col).join(splits.select(name_col), name_col, "left_anti")
               .agg(F.count(F.lit(1)).alias("violations"))
               .select(F.lit("unassigned_files").alias("check"), "violations"))
    return multi.unionByName(missing)


def files_by_repo(files: DataFrame, name_col: str = "filename") -> DataFrame:
    """AGG9: files per repository (count; the long form is (repo_key, filename))."""
    return (with_repo_columns(files.select(name_col), name_col)
            .groupBy("repo_key", "repo_name").agg(F.count(F.lit(1)).alias("files")))


def split_summary(splits: DataFrame) -> DataFrame:
    """AGG10: repositories and files per set."""
    return splits.groupBy("set").agg(F.countDistinct("repo_name").alias("repositories"),
                                     F.count(F.lit(1)).alias("files"))
