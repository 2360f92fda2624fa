"""Removal of byte strings that occur again, over a sorted cover of sampled positions.

A difference cover samples positions so that any two equal 200-byte strings
hold sampled positions at the same offset.  Here the cover is chosen by
content, not by position modulo a constant: the position whose 96-byte string
has the smallest hash among the 105 in a window, the leftmost of equals.  That
keeps the property with about one position in 46 instead of two in three, so
the text's suffixes never have to be shuffled.

1. Sampled positions are sorted by the name of their string (its hash) and
   the name of their whole context, the bytes of all windows that chose them.
   Names that occur once are dropped, equal contexts are repeats as a whole.
2. The remaining positions, whose strings are shared but not their contexts,
   are sorted again with their context bytes, and the windows in them are
   compared within a name (a name with very many contexts by its windows' own names).
3. Covered bytes are merged per text and cut out.

Names are 64-bit hashes; a repeat needs the string's and the context's (or
window's) names to be equal, 128 bits together.  Windows never cross texts.

Defined results: a null or empty text has no bytes; texts under 200 bytes
lose none; copies (repeated rows included) of a text of 200 bytes or more
lose all; a null id is an id like any other; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import add_columns, ranges, sha256_hex
from corpusmill.session import reliable_checkpoint

LENGTH = 200
GRAM = 96  # bytes of a sampled position's string: 64 + 32
#: A long text is sampled in parts of so many bytes (positions take 23 bits beside a hash).
PART = 1 << 22
#: Names with more contexts are compared by their windows' names in a hash aggregation.
MANY_CONTEXTS = 2000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position, by doubling."""
    h = (b.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    power, width, half = _MULTIPLIER, 1, None
    with np.errstate(over="ignore"):
        while width < 64:
            h = h[:-width] * power + h[width:]
            power, width = power * power, 2 * width
            if width == 32:
                half, half_power = h, power
        n = len(b) - GRAM + 1
        h = h[:n] * half_power + half[64:64 + n]
        for shift, factor in ((29, 0xBF58476D1CE4E5B9), (32, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def sample(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(position, first window, last window, name) of the sampled positions, by parts."""
    whole = np.frombuffer(data, np.uint8)
    window = LENGTH - GRAM + 1
    for start in range(0, max(len(data) - LENGTH + 1, 0), PART):
        b = whole[start:start + PART + LENGTH - 1]
        h = gram_hashes(b)
        ranked = (h >> np.uint64(23) << np.uint64(23)) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while 2 * width <= window:
            ranked = np.minimum(ranked[:-width], ranked[width:])
            width *= 2
        n = len(h) - window + 1
        least = np.minimum(ranked[:n], ranked[window - width:window - width + n])
        chosen = (least & np.uint64((1 << 23) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        last = np.append(first[1:] - 1, n - 1)
        at = chosen[first]
        yield at + start, first + start, last + start, h[at].view(np.int64)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def positions(docs: DataFrame, text_col: str) -> DataFrame:
    """(name, context, text_key, place): one row for each sampled position of each text.

    place packs the first window's start, the windows' number and 18 bits of the text's length."""
    schema = pa.schema([("name", pa.int64()), ("context", pa.int64()), ("text_key", pa.int64()), ("place", pa.int64())])

    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for text, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = (text or "").encode()
                view = memoryview(data)
                for at, first, last, name in sample(data):
                    context = [signed(digest(view[a:b + LENGTH], p - a))
                               for a, b, p in zip(first.tolist(), last.tolist(), at.tolist())]
                    place = (first << 25) | ((last - first) << 18) | (len(data) & 0x3FFFF)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(name), pa.array(context, pa.int64()),
                         pa.array(np.full(len(at), key)), pa.array(place)], schema=schema)

    return (docs.select(F.col(f"`{text_col}`").alias("t"), F.xxhash64(F.col(f"`{text_col}`")).alias("text_key"))
            .mapInArrow(run, "name long, context long, text_key long, place long"))


def place_columns() -> list:
    return [F.shiftright("place", 25).alias("first"), F.shiftright("place", 18).bitwiseAND(F.lit(127)).alias("more"),
            F.col("place").bitwiseAND(F.lit(0x3FFFF)).alias("size")]


def window_names(data: bytes, windows: int) -> list[int]:
    view, digest = memoryview(data), xxhash.xxh3_64_intdigest
    return [signed(digest(view[i:i + LENGTH])) for i in range(windows)]


def repeated_windows(batches):
    """(text_key, size, start, end) of repeated windows, from contexts sorted by name."""
    def settle(rows: list[dict]):
        names = [window_names(r["bytes"], r["more"] + 1) for r in rows]
        owner: dict[int, int] = {}
        for i, mine in enumerate(names):
            for n in mine:
                owner[n] = i if owner.get(n, i) == i else -1
        for r, mine in zip(rows, names):
            if r["wanted"]:
                hit = np.array([owner[n] < 0 for n in mine])
                for i in np.flatnonzero(hit & ~np.concatenate(([False], hit[:-1]))).tolist():
                    end = i
                    while end + 1 < len(hit) and hit[end + 1]:
                        end += 1
                    yield r["text_key"], r["size"], r["first"] + i, r["first"] + end + LENGTH

    def out(found):
        cols = list(zip(*found)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                          names=["text_key", "size", "start", "end"])

    rows: list[dict] = []
    for batch in batches:
        found = []
        for r in batch.to_pylist():
            if rows and r["name"] != rows[0]["name"]:
                found += settle(rows)
                rows = []
            rows.append(r)
        yield out(found)
    yield out(list(settle(rows)))


def repeated_spans(docs: DataFrame, text_col: str = "text", many: int = MANY_CONTEXTS) -> DataFrame:
    """(text_key, size, spans): byte spans covered by repeated strings, by text (its hash and
    18 bits of its length); spans are (start, end) and may overlap."""
    by_name, by_context = Window.partitionBy("name"), Window.partitionBy("name", "context")
    shared = (positions(docs, text_col)
              .withColumn("copies", F.count(F.lit(1)).over(by_context))
              .withColumn("number", F.row_number().over(by_context.orderBy("context")))
              .withColumn("contexts", F.sum(F.when(F.col("number") == 1, 1).otherwise(0)).over(by_name))
              .where((F.col("copies") > 1) | (F.col("contexts") > 1)))
    shared = reliable_checkpoint(shared.select(
        "name", "text_key", "place", (F.col("copies") == 1).alias("wanted"), F.col("contexts").cast("int").alias("contexts"),
        ((F.col("contexts") > 1) & (F.col("number") == 1)).alias("open")))
    whole = shared.where(~F.col("wanted")).select("text_key", "place").distinct().select("text_key", *place_columns())
    whole = whole.select("text_key", "size", F.col("first").alias("start"),
                         (F.col("first") + F.col("more") + LENGTH).alias("end"))
    asked = (shared.where("open").select("text_key", "name", "wanted", "contexts", *place_columns())
             .groupBy("text_key", "size")
             .agg(F.collect_list(F.struct("name", "first", "more", "wanted", "contexts")).alias("asked")))
    keyed = docs.select(F.col(f"`{text_col}`").alias("t"), F.xxhash64(F.col(f"`{text_col}`")).alias("text_key"),
                        F.octet_length(F.col(f"`{text_col}`")).cast("long").bitwiseAND(F.lit(0x3FFFF)).alias("size"))
    contexts = keyed.join(asked, ["text_key", "size"]).mapInArrow(
        cut_contexts, "name long, text_key long, size long, first long, more int, wanted boolean, contexts int, bytes binary")
    contexts = reliable_checkpoint(contexts)
    few = contexts.where(F.col("contexts") <= many)
    close = (few.repartition("name").sortWithinPartitions("name")
             .select("name", "text_key", "size", "first", "more", "wanted", "bytes")
             .mapInArrow(repeated_windows, "text_key long, size long, start long, end long"))
    hot = contexts.where(F.col("contexts") > many).mapInArrow(
        name_windows, "window long, name long, text_key long, size long, start long, wanted boolean")
    again = hot.groupBy("name", "window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    far = (hot.where("wanted").join(again, ["name", "window"])
           .select("text_key", "size", "start", (F.col("start") + LENGTH).alias("end")))
    return (whole.unionByName(close).unionByName(far).groupBy("text_key", "size")
            .agg(F.collect_list(F.struct("start", "end")).alias("spans")))


def cut_contexts(batches):
    for batch in batches:
        rows = []
        seen = set()
        for r in batch.to_pylist():
            data, key = r["t"].encode(), (r["text_key"], r["size"])
            if key in seen:  # copies have the same contexts
                continue
            seen.add(key)
            rows += [{**a, "text_key": key[0], "size": key[1],
                      "bytes": data[a["first"]:a["first"] + a["more"] + LENGTH]} for a in r["asked"]]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("name", pa.int64()), ("text_key", pa.int64()), ("size", pa.int64()), ("first", pa.int64()),
            ("more", pa.int32()), ("wanted", pa.bool_()), ("contexts", pa.int32()), ("bytes", pa.binary())]))


def name_windows(batches):
    for batch in batches:
        rows = [{"window": n, "name": r["name"], "text_key": r["text_key"], "size": r["size"],
                 "start": r["first"] + i, "wanted": r["wanted"]}
                for r in batch.to_pylist() for i, n in enumerate(window_names(r["bytes"], r["more"] + 1))]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("window", pa.int64()), ("name", pa.int64()), ("text_key", pa.int64()), ("size", pa.int64()),
            ("start", pa.int64()), ("wanted", pa.bool_())]))


def cut(data: bytes, spans: list[dict]) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal covered runs, and the bytes that stay."""
    runs: list[list[int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    kept, at = [], 0
    for a, b in runs:
        kept.append(data[at:a])
        at = b
    return [tuple(r) for r in runs], b"".join([*kept, data[at:]])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   many: int = MANY_CONTEXTS) -> DataFrame:
    """(id, n_bytes, removed_spans, kept) of each text; kept holds the remaining bytes."""
    found = repeated_spans(docs, text_col, many)
    keyed = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("whole_text"),
                        F.xxhash64(F.col(f"`{text_col}`")).alias("text_key"),
                        F.octet_length(F.col(f"`{text_col}`")).cast("long").bitwiseAND(F.lit(0x3FFFF)).alias("size"))
    joined = keyed.join(found, ["text_key", "size"], "left")

    def make():
        def fn(texts, spans):
            n, out, kept = [], [], []
            for t, s in zip(texts, spans):
                data = (t or "").encode()
                runs, rest = cut(data, s or [])
                n.append(len(data))
                out.append([{"start": a, "end": b} for a, b in runs])
                kept.append(rest)
            return [n, out, kept]

        return fn

    return add_columns(joined, ["whole_text", "spans"],
                       "n_bytes long, removed_spans array<struct<start:long,end:long>>, kept binary", make, [id_col])


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns of a documents table."""
    out = remove_repeats(docs)
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
                      F.size("removed_spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
