"""Token bags and document statistics (AGG1-AGG3, PRJ6, JN9 dictionary)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.text import let
from corpusmill.session import adaptive_caching, reliable_checkpoint

MIN_TOKENS = 20  # fixed value: minimum tokens per indexed file


def min_tokens(docs: DataFrame, tokens_col: str = "tokens", minimum: int = MIN_TOKENS) -> DataFrame:
    """PRJ6: keep documents with at least ``minimum`` tokens, repeats counted."""
    return docs.where(F.size(tokens_col) >= minimum)


def token_bag(docs: DataFrame, id_col: str = "id", tokens_col: str = "tokens") -> DataFrame:
    """AGG1: (id, token, cnt).  Partial aggregation runs before the shuffle.

    ``explode_outer`` + a null filter instead of ``explode``: the filter the
    optimizer infers from ``explode`` would be pushed under an upstream
    repartition and evaluate the tokeniser twice.
    """
    return (docs.select(F.col(id_col).alias(id_col), F.explode_outer(tokens_col).alias("token"))
            .where(F.col("token").isNotNull())
            .groupBy(id_col, "token").agg(F.count(F.lit(1)).alias("cnt")))


def doc_totals(docs: DataFrame, id_col: str = "id", tokens_col: str = "tokens") -> DataFrame:
    """AGG2: total (n) and distinct (k) tokens per document, no shuffle."""
    return docs.select(id_col, F.size(tokens_col).alias("n"),
                       F.size(F.array_distinct(tokens_col)).alias("k"))


def index_size(docs: DataFrame, project_col: str = "project") -> DataFrame:
    """AGG3: indexed files per project plus the grand total (rollup)."""
    return (docs.rollup(project_col).agg(F.count(F.lit(1)).alias("files"))
            .orderBy(F.col(project_col).asc_nulls_last()))


def token_order(bags: DataFrame) -> DataFrame:
    """Global token order (document frequency asc, token) with order-preserving ids.

    ``tid`` comes from ``monotonically_increasing_id`` right after a range-
    partitioned sort, so tid order equals (df, token) order.  The result is
    checkpointed: ids must not change if the frame is evaluated twice.
    """
    adaptive_caching(bags.sparkSession)
    vocab = bags.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    # persisted: the range partitioner's sampling job would recompute it
    vocab = vocab.persist(StorageLevel.MEMORY_AND_DISK)
    ranked = vocab.orderBy("df", "token").withColumn("tid", F.monotonically_increasing_id())
    ranked = reliable_checkpoint(ranked)
    vocab.unpersist()
    return ranked


def build_vocab(tokens_df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """JN9 build: distinct tokens with dense ids in first-seen order.

    First-seen = (first document id, first position).  Dense ids come from a
    distributed row numbering, not a single-partition window.
    """
    from corpusmill.operators.ordering import with_row_index
    # array_distinct keeps first occurrences in text order, so the position
    # among distinct tokens orders them like their first raw position; each
    # document contributes one row per token, so min(id) and min_by(pos, id)
    # are exact -- and hash-aggregatable, unlike a struct minimum
    firsts = tokens_df.select("id", F.posexplode(F.array_distinct(tokens_col)).alias("pos", "token"))
    first = firsts.groupBy("token").agg(F.min("id").alias("fid"), F.min_by("pos", "id").alias("fpos"))
    return with_row_index(first, [F.col("fid"), F.col("fpos")], "token_id").drop("fid", "fpos")


# Fixed bound for broadcasting a vocabulary (rows); above it the lookup is a
# shuffle join on token, in which a token of more documents is salted.
BROADCAST_VOCAB_MAX_ROWS = 2_000_000
HOT_TOKEN_ROWS = 20_000
BATCH_BYTES = 8 << 20  # of an Arrow batch of tokens


def token_positions(tokens_df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """(id, token, positions): one row for each distinct token of a document, without a shuffle.

    The tokens of a row are sorted with their positions, and equal neighbours become one entry.  A
    document without tokens keeps one row of nulls.
    """
    def runs(x: Column) -> Column:
        starts = F.filter(F.transform(x["t"], lambda t, k: F.when((k == 0) | (t != F.get(x["t"], k - 1)), k)), lambda k: k.isNotNull())
        return let(starts, lambda at: F.transform(at, lambda k, n: F.struct(
            F.get(x["t"], k).alias("token"),
            F.slice(x["i"], k + 1, F.coalesce(F.get(at, n + 1), F.size(x["i"])) - k).alias("positions"))))

    placed = F.sort_array(F.transform(tokens_col, lambda t, i: F.struct(t.alias("t"), i.alias("i"))))
    entries = let(placed, lambda s: let(F.struct(s["t"].alias("t"), s["i"].alias("i")), runs))
    return tokens_df.select("id", F.explode_outer(entries).alias("e")).select("id", "e.token", "e.positions")


def ids_in_place(tokens_df: DataFrame, vocab: DataFrame, tokens_col: str, unk_id: int) -> DataFrame:
    """(id, ids): the token ids of each row, looked up where the row is.

    The distinct tokens of an Arrow batch are sought in the broadcast vocabulary;
    no row is made for an occurrence.  A row without tokens gives an empty array.
    """
    spark = tokens_df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    table = vocab.select(F.col("token").cast("string").alias("token"), F.col("token_id").cast("long").alias("token_id")).toArrow()
    sent = spark.sparkContext.broadcast((table.column("token").combine_chunks(), table.column("token_id").to_numpy()))
    d = tokens_df.select("id", F.coalesce(F.col(tokens_col), F.array().cast("array<string>")).alias("tokens"))
    schema = T.StructType([d.schema["id"], T.StructField("ids", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ids = sent.value
        for batch in batches:
            column = batch.column("tokens")
            lens = np.array(pc.list_value_length(column), np.int64)
            flat = column.flatten().dictionary_encode()
            here = pc.index_in(known, value_set=flat.dictionary.cast(known.type), skip_nulls=True)
            met = np.flatnonzero(here.is_valid().to_numpy(zero_copy_only=False))
            of = np.full(len(flat.dictionary) + 1, unk_id, np.int64)  # the last one: a null
            of[here.take(pa.array(met)).to_numpy(zero_copy_only=False).astype(np.int64)] = ids[met]
            found = of[pc.fill_null(flat.indices.cast(pa.int64()), len(of) - 1).to_numpy(zero_copy_only=False)]
            ends = pa.array(np.concatenate(([0], np.cumsum(lens))), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(ends, pa.array(found))], names=["id", "ids"])

    return d.mapInArrow(run, schema)


def vocab_encode(tokens_df: DataFrame, vocab: DataFrame, tokens_col: str = "tokens",
                 unk_id: int = -1, broadcast_max_rows: int = BROADCAST_VOCAB_MAX_ROWS) -> DataFrame:
    """JN9 lookup: token array -> id array, unknown -> ``unk_id``.

    The vocabulary grows with the corpus, so it is broadcast only after its row
    count has been checked against ``broadcast_max_rows``; then the tokens of a
    row are looked up where they are, and one row of ids a document is grouped
    by id (rows of one id are merged by position).  Above the bound tokens go
    through a shuffle join: one row for each (document, token) with its
    positions, however often the token stands there, and its id is scattered
    to them; a token of more than HOT_TOKEN_ROWS documents is salted.
    """
    from corpusmill.operators.neardup import salted_join_sides
    v = vocab.select("token", "token_id")
    tid = F.coalesce("token_id", F.lit(unk_id).cast("long")).alias("tid")
    if v.count() <= broadcast_max_rows:
        rows = ids_in_place(tokens_df, v, tokens_col, unk_id).groupBy("id").agg(F.collect_list("ids").alias("_r"))
        placed = F.sort_array(F.flatten(F.transform("_r", lambda r: F.transform(r, lambda t, k: F.struct(k.alias("pos"), t.alias("tid"))))))
        merged = F.transform(placed, lambda p: p["tid"])
        return rows.select("id", F.when(F.size("_r") == 1, F.get("_r", 0)).otherwise(merged).alias("token_ids"))
    pairs = token_positions(tokens_df, tokens_col)
    hot = (pairs.groupBy("token").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_TOKEN_ROWS)
           .select("token", F.ceil(F.col("_n") / F.lit(HOT_TOKEN_ROWS)).cast("int").alias("_salts")))
    big, small, keys = salted_join_sides(pairs, v, ["token"], hot, "id")
    entries = F.collect_list(F.when(F.col("positions").isNotNull(), F.struct("positions", tid)))
    scattered = F.sort_array(F.flatten(F.transform(F.col("_e"), lambda e: F.transform(
        e["positions"], lambda p: F.struct(p.alias("pos"), e["tid"].alias("tid"))))))
    return (big.join(small, keys, "left").groupBy("id").agg(entries.alias("_e")).select("id", scattered.alias("_p"))
            .select("id", F.col("_p.tid").alias("token_ids")))
