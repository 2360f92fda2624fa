"""Incremental ingestion of token documents with Structured Streaming.

Token batches (gzip JSONL, as written by ``write_token_docs``) that land in
a folder are parsed, filtered to indexable documents (>= 20 tokens) and
appended to a parquet bag index with exactly-once semantics (file source +
checkpointed sink).  The near-duplicate join then runs in batch over the
index.  The reference itself has no event-time streaming; this is the
streaming form of its index build.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusmill.functions.text import entry_id
from corpusmill.operators.bags import MIN_TOKENS


def token_doc_stream(spark: SparkSession, directory: str, tokens_field: str = "tokens",
                     id_fields: list[str] | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (project, id, tokens) over the ``*.gz`` files of a folder."""
    id_fields = id_fields or ["filename"]
    schema = T.StructType([T.StructField(f, T.StringType()) for f in id_fields]
                          + [T.StructField(tokens_field, T.ArrayType(T.StringType()))])
    reader = spark.readStream.format("text").option("pathGlobFilter", "*.gz")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(directory).select("value", F.col("_metadata.file_path").alias("project"))
    parsed = (raw.where(F.col("value") != F.lit("null"))
              .select("project", F.from_json("value", schema).alias("d")))
    return parsed.select("project", entry_id(*[F.col("d")[f] for f in id_fields]).alias("id"),
                         F.col("d")[tokens_field].alias("tokens"))


def start_index(stream: DataFrame, out_path: str, checkpoint_location: str,
                minimum: int = MIN_TOKENS, available_now: bool = True) -> StreamingQuery:
    """Append (project, id, n, k, tokens) rows of indexable documents to parquet;
    bags are built in batch by ``token_bag`` over the index."""
    rows = (stream.where(F.size("tokens") >= minimum)
            .select("project", "id", F.size("tokens").alias("n"),
                    F.size(F.array_distinct("tokens")).alias("k"), "tokens"))
    writer = (rows.writeStream.format("parquet").option("path", out_path)
              .option("checkpointLocation", checkpoint_location).outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
