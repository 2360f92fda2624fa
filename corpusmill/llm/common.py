"""Helpers shared by the operators: reading a table, adding columns from
Arrow batches, and the word splitters fixed by the contracts."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Texts are handed to Python code in runs of about so many characters.
RUN_CHARS = 4_000_000
#: Bytes of an Arrow batch that goes to Python code; one row at least.
BATCH_BYTES = 8 << 20

# The ASCII letters, and the white space of the word patterns.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
SPACES = " \t\n\x0b\x0c\r"

#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` after lower-casing; all others become a blank.
ALNUM_TABLE = bytes(
    (b + 32 if 65 <= b <= 90 else b) if (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) else 32
    for b in range(256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def alnum_words(text: str | None) -> list[bytes]:
    """Lower-cased words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` as UTF-8; null has none."""
    return text.encode().translate(ALNUM_TABLE).split() if text else []


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def runs(texts: list[str | None], most: int = RUN_CHARS) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of texts holding about ``most`` characters, one text at least."""
    start = size = 0
    for i, t in enumerate(texts):
        if size >= most:
            yield start, i
            start, size = i, 0
        size += len(t or "")
    if start < len(texts):
        yield start, len(texts)


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python by batches of BATCH_BYTES, however long their texts are.  Runtime SQL setting."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def add_columns(df: DataFrame, inputs: list[str], outputs: str | T.StructType,
                make: Callable[[], Callable[..., list]], keep: list[str] | None = None) -> DataFrame:
    """Append columns computed from Arrow batches, without a shuffle.

    ``make()`` runs once in a task and returns a function that takes the
    input columns of a batch as Python lists and returns one sequence for
    each output column.  ``keep`` names the columns carried along (default
    all); one whose name an output has, in any case, is replaced by it.
    """
    out = T._parse_datatype_string(outputs) if isinstance(outputs, str) else outputs
    taken = {f.name.lower() for f in out.fields}
    carried = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    # inputs are carried under names of their own, so that a replaced column can still be an input
    src = df.select(*[F.col(f"`{c}`") for c in carried],
                    *[F.col(f"`{c}`").alias(f"__in_{i}") for i, c in enumerate(inputs)])
    small_batches(df.sparkSession)
    schema = T.StructType([src.schema[c] for c in carried] + list(out.fields))
    arrow = to_arrow_schema(out)
    n_carried = len(carried)

    def body(batches):
        fn = None
        for batch in batches:
            if fn is None:
                fn = make()
            if batch.num_rows == 0:
                continue
            made = fn(*[batch.column(n_carried + i).to_pylist() for i in range(len(inputs))])
            arrays = [a if isinstance(a, pa.Array) else pa.array(a, f.type) for a, f in zip(made, arrow)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(n_carried)] + arrays,
                names=carried + [f.name for f in arrow])

    return src.mapInArrow(body, schema)


def boxed(df: DataFrame, **inputs: str) -> DataFrame:
    """All columns of ``df`` in one struct column ``row``, and named inputs beside it: whatever
    columns a table has, results added to it clash with none.  ``unboxed`` is the way back."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     *[F.col(f"`{c}`").alias(k) for k, c in inputs.items()])


def unboxed(df: DataFrame) -> DataFrame:
    return df.select("row.*")


_KEPT: dict = {}


def kept(key, make: Callable):
    """What a Python worker keeps from task to task: the one object that was asked for last.
    A worker serves stages of many operators, so each one's words and models go when another's are made."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def crc_mod(column: str, n: int):
    """crc32 of the id as text, modulo ``n`` (null for a null id)."""
    return F.crc32(F.col(f"`{column}`").cast("string").cast("binary")) % n


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Concatenated arange(s, e) of each pair."""
    lens = ends - starts
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.repeat(starts - np.concatenate(([0], np.cumsum(lens)[:-1])), lens)
    return first + np.arange(total)
