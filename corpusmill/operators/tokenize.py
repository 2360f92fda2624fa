"""Tokenisation jobs (TOK1, TOK3-TOK5) on the language-neutral lexer, in Arrow batches;
any other pattern is native (``regexp_extract_all``)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.lexer import lexed, small_batches

# Fixed value: the language-neutral code lexer pattern (identifiers, runs of
# digits, any single other non-space character).
CODE_TOKEN_PATTERN = r"[A-Za-z_][A-Za-z0-9_]*|[0-9]+|[^\sA-Za-z0-9_]"
# Fixed value: a token that starts like an identifier (identifier-only mode).
IDENTIFIER_START = r"^[A-Za-z_]"


def regex_tokens(content: Column | str, pattern: str = CODE_TOKEN_PATTERN) -> Column:
    """TOK1 as a column expression: array of token strings, in text order."""
    c = F.col(content) if isinstance(content, str) else content
    if pattern == CODE_TOKEN_PATTERN:
        small_batches()
        return code_tokens(c)
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


@F.arrow_udf(T.ArrayType(T.StringType()))
def code_tokens(content: pa.Array) -> pa.Array:
    """The tokens of CODE_TOKEN_PATTERN."""
    return lexed(content)


def tokenize_regex(files: DataFrame, content_col: str = "content",
                   tokens_col: str = "tokens", pattern: str = CODE_TOKEN_PATTERN,
                   only_identifiers: bool = False) -> DataFrame:
    """TOK1 (+TOK3 in regex mode): add ``tokens`` to every file row."""
    toks = regex_tokens(content_col, pattern)
    if only_identifiers:
        toks = F.filter(toks, lambda t: t.rlike(IDENTIFIER_START))
    return files.withColumn(tokens_col, toks)


def mark_valid(tokenized: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """TOK4: a file without any token (null or empty content) is invalid."""
    return tokenized.withColumn("valid", F.coalesce(F.size(tokens_col) > 0, F.lit(False)))


def split_valid_invalid(tokenized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """TOK4: (valid rows, quarantined rows)."""
    return tokenized.where("valid"), tokenized.where("NOT valid")


def validity_counts(tokenized: DataFrame) -> DataFrame:
    """TOK4 counters: total and valid files in one aggregation."""
    return tokenized.agg(F.count(F.lit(1)).alias("total_files"),
                         F.count_if(F.col("valid")).alias("valid_files"))


def assign_batches(files: DataFrame, n: int, name_col: str = "filename",
                   exact: bool = True) -> DataFrame:
    """TOK5: batch number for every file.

    ``exact``: names sorted in byte order and dealt round-robin, batch =
    index mod n + 1 (index from a distributed row numbering).  Otherwise a
    hash placement that needs no global order.
    """
    if n < 1:
        raise ValueError("batch count must be >= 1")
    if not exact:
        return files.withColumn("batch", F.pmod(F.xxhash64(name_col), F.lit(n)) + 1)
    from corpusmill.operators.ordering import with_row_index
    indexed = with_row_index(files, [F.col(name_col)], "_idx")
    return indexed.withColumn("batch", (F.pmod(F.col("_idx"), F.lit(n)) + 1).cast("int")).drop("_idx")
