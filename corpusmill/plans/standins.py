"""Stand-ins that map the driver tables to the reference's inputs.

Every stand-in is a projection or aggregation of a driver table, so the
work of each query grows with the tables.

Fixed values: the synthesised file name is
``'own' || (doc_id % 7) || '_' || source || '-' || doc_id || '.py'``; the
training log uses ``user_id % 4`` as run and weeks since 2024-01-01 as
epoch; predictions edit the ground truth by ``doc_id % 4`` (0 unchanged,
1 last character dropped, 2 suffix ``</s>x``, 3 suffix ``{``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.ordering import with_group_prefix
from corpusmill.operators.tokenize import tokenize_regex

EPOCH_ORIGIN = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread a scan that arrived in fewer splits than the cluster has
    cores (a single-row-group file); a large input keeps its scan splits."""
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want, key)
    return df


def file_name(doc_id, source):
    return F.concat(F.lit("own"), F.pmod(doc_id, F.lit(7)).cast("string"), F.lit("_"), source,
                    F.lit("-"), doc_id.cast("string"), F.lit(".py"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code files: (doc_id, filename, content, project, lang)."""
    d = spread(table(spark, sf_dir, "documents"), "doc_id")
    return d.select("doc_id", file_name(F.col("doc_id"), F.col("source")).alias("filename"),
                    F.col("text").alias("content"), F.col("source").alias("project"), "lang")


def token_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token documents (id = doc_id) from the regex lexer."""
    f = files(spark, sf_dir)
    return tokenize_regex(f.select(F.col("doc_id").alias("id"), "content", "project")).drop("content")


def repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repository list: customer(c_name, c_mktsegment, c_acctbal)."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_name").alias("repo"), F.col("c_mktsegment").alias("lang"),
                    F.col("c_acctbal").alias("stars"))


def train_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training log: (run, epoch, step, epoch_step, loss) from ``events``."""
    e = table(spark, sf_dir, "events")
    run = F.pmod(F.col("user_id"), F.lit(4)).alias("run")
    epoch = F.floor(F.datediff(F.to_date("ts"), F.lit(EPOCH_ORIGIN).cast("date")) / 7).cast("int")
    base = e.select(run, epoch.alias("epoch"), "ts", "event_id", F.col("value").alias("loss"))
    # per-run and per-epoch step numbers without a window over a whole run
    stepped = with_group_prefix(base, ["run"], ["ts", "event_id"], None, "step",
                                sub_groups={"epoch_step": ["run", "epoch"]})
    return stepped.select("run", "epoch", "step", "epoch_step", "loss")


def epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-epoch accuracy: ``events`` aggregated by day."""
    e = table(spark, sf_dir, "events")
    day = F.datediff(F.to_date("ts"), F.lit(EPOCH_ORIGIN).cast("date")).cast("int")
    return (e.groupBy(day.alias("epoch"))
            .agg(F.round(F.avg("value"), 2).alias("acc"))
            .select("epoch", F.concat(F.lit("epoch-"), F.col("epoch").cast("string")).alias("model"), "acc"))
